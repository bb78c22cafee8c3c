"""§ deployment analytics. Orders stand for merged changes; a repository is nation/priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import deployments as D
from .registry import query

END, MONTHS = "2001-08-01", 3

BASE_SQL = """
    merged AS (SELECT o_orderkey AS id, o_orderdate AS merged_at, n_name || '/' || o_orderpriority AS repo
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    daily AS (SELECT CAST(merged_at AS DATE) AS "date", repo, count(DISTINCT id) AS deployments FROM merged GROUP BY 1, 2)"""

FILLED_SQL = BASE_SQL + """,
    calendar AS (SELECT CAST(unnest(generate_series(DATE '2001-05-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS "date"),
    filled AS (SELECT "date", repo, CAST(sum(v) AS BIGINT) AS deployments FROM (
      SELECT "date", repo, deployments AS v FROM daily
      UNION SELECT c."date", r.repo, 0 FROM calendar c, (SELECT DISTINCT repo FROM daily) r) GROUP BY 1, 2)"""

CLASS_SQL = FILLED_SQL + """,
    weeks AS (SELECT repo, week("date") AS u, count(*) FILTER (deployments > 0) AS n FROM filled GROUP BY 1, 2),
    months AS (SELECT repo, month("date") AS u, count(*) FILTER (deployments > 0) AS n FROM filled GROUP BY 1, 2),
    classes AS (
      SELECT repo, CASE WHEN quantile_disc(n, 0.5) >= 3 THEN 1 WHEN quantile_disc(n, 0.5) >= 1 THEN 2 END AS class
      FROM weeks GROUP BY repo
      UNION ALL SELECT repo, CASE WHEN quantile_disc(n, 0.5) >= 1 THEN 3 ELSE 4 END FROM months GROUP BY repo),
    labelled AS (SELECT repo, frequency FROM (SELECT repo, min(class) AS class FROM classes GROUP BY repo)
      JOIN (VALUES (1,'daily'),(2,'weekly'),(3,'monthly'),(4,'yearly')) f(id, frequency) ON f.id = class)"""


def merged(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("merged_at"),
        F.concat("n_name", F.lit("/"), "o_orderpriority").alias("repo"))


def daily(t):
    return D.deployments(merged(t), "id", "merged_at", "repo")


@query("v_deployments", f"WITH {BASE_SQL} SELECT * FROM daily")
def v_deployments(t):
    return daily(t)


@query("v_deployments_gapfilled", f"WITH {FILLED_SQL} SELECT * FROM filled")
def v_deployments_gapfilled(t):
    return D.gap_fill(daily(t), END, MONTHS)


@query("v_deployment_frequency", f"WITH {CLASS_SQL} SELECT repo, frequency FROM labelled")
def v_deployment_frequency(t):
    return D.deployment_frequency(D.gap_fill(daily(t), END, MONTHS))


@query("v_repo_label", f"""
    WITH {BASE_SQL} SELECT id, split_part(repo, '/', -1) AS label FROM merged""")
def v_repo_label(t):
    return merged(t).select("id", D.repo_label("repo").alias("label"))


@query("v_row_level_access", f"""
    WITH {CLASS_SQL} SELECT repo, frequency FROM labelled WHERE repo IN (
      SELECT n_name || '/2-HIGH' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""")
def v_row_level_access(t):
    bindings = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("group"), F.concat("n_name", F.lit("/2-HIGH")).alias("repo"))
    return D.row_access(D.deployment_frequency(D.gap_fill(daily(t), END, MONTHS)), bindings, "ASIA")
