"""§ windows, dedupe, sort, limit, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from .registry import query

MONTH_SQL = "strftime(o_orderdate, '%Y%m')"
WEEK_SQL = "isoyear(ts) || CAST(week(ts) AS VARCHAR)"


@query("rank_recent_periods", f"""
    SELECT o_custkey, max(o_totalprice) AS best, count(*) AS n FROM (
      SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY {MONTH_SQL} DESC) AS r FROM orders)
    WHERE r <= 5 GROUP BY o_custkey""")
def rank_recent_periods(t):
    rows = t.orders.select("o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("period"))
    return W.top_periods(rows, ["o_custkey"], "period", 5).groupBy("o_custkey").agg(
        F.max("o_totalprice").alias("best"), F.count(F.lit(1)).alias("n"))


def hours(t):
    return t.lineitem.select(F.col("l_suppkey").alias("alias"), F.col("l_quantity").alias("used_hrs"), "l_orderkey",
                             "l_linenumber", "l_partkey", "l_shipdate")


RANKED_SQL = """
    SELECT l_suppkey AS alias, l_orderkey, l_linenumber, l_partkey, row_number() OVER (
      PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey) AS weigth FROM lineitem"""


@query("weight_rank", RANKED_SQL)
def weight_rank(t):
    rows = W.weight_rank(hours(t), "alias", "used_hrs", ["l_orderkey", "l_linenumber", "l_partkey"])
    return rows.select("alias", "l_orderkey", "l_linenumber", "l_partkey", "weigth")


@query("primary_row", f"""
    SELECT alias, l_orderkey, l_linenumber, l_partkey FROM ({RANKED_SQL}) WHERE weigth = 1""")
def primary_row(t):
    """Only the first rank is needed, so one row per key survives each task before the shuffle."""
    others = ["l_orderkey", "l_linenumber", "l_partkey"]
    return W.first_by(hours(t).withColumn("neg", -F.col("used_hrs")), ["alias"], ["neg", *others], others)


@query("keep_latest_periods", f"""
    WITH p AS (SELECT event_id, {WEEK_SQL} AS period, isoyear(ts) * 100 + week(ts) AS code FROM events)
    SELECT event_id, period FROM p WHERE code IN (SELECT DISTINCT code FROM p ORDER BY code DESC LIMIT 3)""")
def keep_latest_periods(t):
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"), F.weekofyear("ts").cast("string"))
    return W.keep_latest_periods(t.events.select("event_id", week.alias("period")), "period", 3)


@query("merge_new_with_old", """
    SELECT user_id, event_type, day, time FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY old, time) AS n FROM (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, 2 AS time, 0 AS old FROM events
          WHERE ts >= TIMESTAMP '2024-01-10'
        UNION ALL SELECT user_id, event_type, CAST(ts AS DATE), 1, 1 FROM events WHERE ts < TIMESTAMP '2024-01-20'))
    WHERE n = 1""")
def merge_new_with_old(t):
    rows = lambda time: t.events.select("user_id", "event_type", F.to_date("ts").alias("day"), F.lit(time).alias("time"), "ts")
    new = rows(2).filter("ts >= timestamp_ntz'2024-01-10'").drop("ts")
    old = rows(1).filter("ts < timestamp_ntz'2024-01-20'").drop("ts")
    return W.merge_new_with_old(new, old, ["time"])


@query("dedupe_keep_last", """
    SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber DESC, l_partkey DESC) AS n
      FROM lineitem) WHERE n = 1""")
def dedupe_keep_last(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    return W.dedupe_keep_last(rows, ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey"])


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                               F.col("c_mktsegment").alias("segment"))
    return people.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
                              allowMissingColumns=True)


@query("union_distinct", "SELECT l_suppkey AS k FROM lineitem UNION SELECT o_custkey FROM orders")
def union_distinct(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k")).union(t.orders.select("o_custkey")).distinct()


@query("order_by", """
    SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey""")
def order_by(t):
    return t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice").orderBy(
        "o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey")


@query("head_n", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def head_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("slice_first", """
    SELECT doc_id, unnest(string_split(text, ' ')[1:24]) AS word FROM documents""")
def slice_first(t):
    return t.documents.select("doc_id", F.explode(F.slice(F.split("text", " "), 1, 24)).alias("word"))
