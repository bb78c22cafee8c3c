"""§ aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.windows import first_by
from ..functions.presto import complete_months, iso_period
from .registry import cents, query

NOW = 1_700_000_000


@query("count_rows", "SELECT count(*) AS n FROM customer")
def count_rows(t):
    return t.customer.agg(F.count(F.lit(1)).alias("n"))


@query("employee_count_snapshot", f"""
    SELECT CAST({NOW} AS BIGINT) AS time, count(*) AS number_of_employees FROM customer""")
def employee_count_snapshot(t):
    return A.snapshot_count(t.customer, NOW)


@query("group_count", """
    SELECT o_orderpriority, count(nullif(o_orderstatus, 'F')) AS n FROM orders GROUP BY o_orderpriority""")
def group_count(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.nullif("o_orderstatus", F.lit("F"))).alias("n"))


@query("group_avg", """
    SELECT l_suppkey, l_returnflag, round(avg(l_quantity), 6) AS value FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def group_avg(t):
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(cents(F.avg("l_quantity"), 6).alias("value"))


@query("group_sum_expr", """
    SELECT l_suppkey, max(l_shipdate) AS last_date, CAST(sum(l_linenumber - 1) AS BIGINT) AS weight_sum
    FROM lineitem GROUP BY l_suppkey""")
def group_sum_expr(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("last_date"),
                                               F.sum(F.col("l_linenumber") - 1).alias("weight_sum"))


@query("count_distinct", """
    SELECT n_name, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_custkey) AS customers FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def count_distinct(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    rows = t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("n_name", F.to_date("o_orderdate").alias("day")).agg(
        F.count_distinct("o_custkey").alias("customers"))


@query("count_if", """
    SELECT o_orderpriority, count(CASE WHEN o_totalprice > 200000 THEN 1 END) AS large FROM orders GROUP BY 1""")
def count_if(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count_if(F.col("o_totalprice") > 200000).alias("large"))


@query("ratio_of_counts", """
    SELECT user_id, round(100 * CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) / CAST(count(*) AS DOUBLE), 9)
           AS share FROM events GROUP BY user_id""")
def ratio_of_counts(t):
    share = A.ratio(F.count_if(F.col("event_type") == "click"), F.count(F.lit(1)), 100)
    return t.events.groupBy("user_id").agg(cents(share, 9).alias("share"))


@query("group_by_dedupe", """
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders GROUP BY ALL""")
def group_by_dedupe(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").dropDuplicates()


@query("group_by_distinct", """
    SELECT l_suppkey, l_linestatus, round(avg(l_tax), 8) AS tax FROM lineitem GROUP BY l_suppkey, l_linestatus""")
def group_by_distinct(t):
    return t.lineitem.groupBy("l_suppkey", "l_linestatus").agg(cents(F.avg("l_tax"), 8).alias("tax"))


@query("collect_join", """
    SELECT o_custkey, string_agg(p, ';' ORDER BY p) AS priorities FROM (
      SELECT DISTINCT o_custkey, coalesce(nullif(o_orderpriority, '2-HIGH'), '') AS p FROM orders) GROUP BY o_custkey""")
def collect_join(t):
    """The reports join lists over distinct rows; a list is as long as the value domain at most."""
    rows = t.orders.select("o_custkey", F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("p")).distinct()
    return A.joined_list(rows, ["o_custkey"], "p", "priorities")


@query("collect_distinct_join", """
    SELECT l_suppkey, string_agg(DISTINCT l_returnflag || l_linestatus, ';' ORDER BY l_returnflag || l_linestatus)
           AS flags FROM lineitem GROUP BY l_suppkey""")
def collect_distinct_join(t):
    rows = t.lineitem.select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("f"))
    return A.joined_set(rows, ["l_suppkey"], "f", "flags")


@query("collect_json", """
    SELECT p_brand, CAST(to_json(list_sort(list(DISTINCT p_type))) AS VARCHAR) AS types FROM part GROUP BY p_brand""")
def collect_json(t):
    return A.json_set(t.part, ["p_brand"], "p_type", "types")


@query("first_of_latest", """
    SELECT o_custkey, o_orderpriority, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC) AS n FROM orders)
    WHERE n = 1""")
def first_of_latest(t):
    return A.latest_value(t.orders, ["o_custkey"], "o_orderdate", "o_orderpriority")


# The words that decide the class of a degree text.
DEGREE_SQL = """CASE WHEN {0} LIKE '%phd %' OR {0} LIKE '%doktor %' OR {0} LIKE '%doktorgrad%'
      OR {0} LIKE '%profesjonsstudiet%' THEN 3
    WHEN {0} LIKE '%master%' OR {0} LIKE '%sivil%' OR {0} LIKE '%siv.%' OR {0} LIKE '%cand%' OR {0} LIKE '%m.%' THEN 2
    WHEN {0} LIKE '%bachelor %' OR {0} LIKE '%bachelor,%' OR {0} LIKE '%bachelor' OR {0} LIKE '%(bachelor)%'
      OR {0} LIKE '%bachelorgrad%' OR {0} LIKE '%ingeniør%' OR {0} LIKE '%b.%' OR {0} LIKE '%3-år%' THEN 1 ELSE 0 END"""


@query("max_rank_class", f"""
    SELECT class, count(*) AS n FROM (
      SELECT source, lang, max({DEGREE_SQL.format('lower(text)')}) AS class FROM documents GROUP BY source, lang)
    GROUP BY class""")
def max_rank_class(t):
    best = t.documents.groupBy("source", "lang").agg(F.max(A.degree_class(F.col("text"))).alias("class"))
    return best.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query("approx_median", """
    SELECT l_suppkey, quantile_disc(l_quantity, 0.5) AS median,
           CASE WHEN quantile_disc(l_quantity, 0.5) >= 26 THEN 1 ELSE 2 END AS class FROM lineitem GROUP BY l_suppkey""")
def approx_median(t):
    median = t.lineitem.groupBy("l_suppkey").agg(F.percentile_approx("l_quantity", 0.5).alias("median"))
    return median.select("l_suppkey", "median", F.when(F.col("median") >= 26, 1).otherwise(2).alias("class"))


@query("two_level_agg", """
    SELECT user_id, quantile_disc(days, 0.5) AS median_days FROM (
      SELECT user_id, week(day) AS w, count(*) AS days FROM (
        SELECT user_id, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2) GROUP BY 1, 2) GROUP BY user_id""")
def two_level_agg(t):
    days = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    weeks = days.groupBy("user_id", F.weekofyear("day").alias("w")).agg(F.count(F.lit(1)).alias("days"))
    return weeks.groupBy("user_id").agg(F.percentile_approx("days", 0.5).alias("median_days"))


@query("min_over_union", """
    SELECT user_id, min(class) AS class FROM (
      SELECT user_id, CASE WHEN count(*) > 100 THEN 1 ELSE 3 END AS class FROM events GROUP BY user_id
      UNION SELECT user_id, CASE WHEN count(DISTINCT event_type) >= 5 THEN 2 ELSE 4 END FROM events GROUP BY user_id)
    GROUP BY user_id""")
def min_over_union(t):
    a = t.events.groupBy("user_id").agg(F.when(F.count(F.lit(1)) > 100, 1).otherwise(3).alias("class"))
    b = t.events.groupBy("user_id").agg(F.when(F.count_distinct("event_type") >= 5, 2).otherwise(4).alias("class"))
    return a.unionByName(b).groupBy("user_id").agg(F.min("class").alias("class"))


@query("first_by_sort", """
    SELECT o_custkey, arg_min(o_orderkey, (CAST(o_totalprice AS VARCHAR), o_orderkey)) AS o_orderkey,
           min(CAST(o_totalprice AS VARCHAR)) AS price FROM orders GROUP BY o_custkey""")
def first_by_sort(t):
    # Text order on purpose; the price is brought to the plain decimal text first.
    text = F.regexp_replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "(\\.\\d)0$", "$1")
    rows = t.orders.select("o_custkey", "o_orderkey", text.alias("price"))
    return first_by(rows, ["o_custkey"], ["price", "o_orderkey"], ["o_orderkey", "price"])


ROLLUP_SQL = """
    SELECT h.customer, e.employees, h.hours, h.reg_period, {now} AS timestamp, h.work_order FROM
      (SELECT o_custkey AS customer, l_partkey AS work_order, {period} AS reg_period, sum(l_quantity) AS hours
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3) h
      JOIN (SELECT o_custkey AS customer, l_partkey AS work_order, count(DISTINCT l_suppkey) AS employees
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) e
      ON h.customer = e.customer AND h.work_order = e.work_order"""
PERIOD_SQL = "isoyear(o_orderdate) || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0')"


@query("project_rollup", ROLLUP_SQL.format(now=f"CAST({NOW} AS INTEGER)", period=PERIOD_SQL))
def project_rollup(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer"), F.col("l_partkey").alias("work_order_description"),
        F.col("l_suppkey").alias("alias"), iso_period("o_orderdate").alias("reg_period"),
        F.col("l_quantity").alias("used_hrs"))
    return A.project_rollup(rows, NOW)


@query("sum_of_sums", """
    SELECT r_name, round(sum(total), 2) AS total, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT c_nationkey, sum(c_acctbal) AS total, count(*) AS n FROM customer GROUP BY c_nationkey)
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def sum_of_sums(t):
    first = t.customer.groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("total"), F.count(F.lit(1)).alias("n"))
    homes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return (first.join(homes, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name").agg(cents(F.sum("total")).alias("total"), F.sum("n").alias("n")))


@query("months_experience", """
    SELECT years, count(*) AS n FROM (
      SELECT c_custkey, CAST(sum(coalesce(date_sub('month', CAST(o_orderdate AS DATE), DATE '2002-03-31'), 0)) AS BIGINT)
             // 12 AS years FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY years""")
def months_experience(t):
    end = F.lit("2002-03-31").cast("date")
    months = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(complete_months(F.to_date("o_orderdate"), end)).alias("m"))
    years = t.customer.select("c_custkey").join(months, "c_custkey", "left").select(
        F.expr("coalesce(m, 0L) div 12").alias("years"))
    return years.groupBy("years").agg(F.count(F.lit(1)).alias("n"))
