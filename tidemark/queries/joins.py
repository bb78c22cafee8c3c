"""§ joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.deployments import frequency_labels, with_label
from ..operators.windows import latest
from ..sources.webhooks import with_channel_names
from .registry import cents, query


@query("join_inner_multi", """
    SELECT l_orderkey, l_linenumber, l_partkey, c_custkey, n_name FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'NATION_7'""")
def join_inner_multi(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).filter("n_name <> 'NATION_7'")
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(homes, F.col("o_custkey") == F.col("c_custkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "c_custkey", "n_name"))


@query("join_left", """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
    LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'""")
def join_left(t):
    mine = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                                                         "o_totalprice")
    return J.left_join(t.customer.select("c_custkey", "c_name"), mine, ["c_custkey"])


@query("join_right", """
    SELECT c_custkey, c_mktsegment, o_orderkey FROM orders RIGHT JOIN customer
    ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'""")
def join_right(t):
    """Keeps all people: the same as a left join from the people's side."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.left_join(t.customer.select("c_custkey", "c_mktsegment"), urgent, ["c_custkey"])


@query("join_full_filtered", """
    SELECT c_custkey, boss, o_orderkey, name FROM
      (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS boss FROM customer) c
      FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Customer#' ||
                 lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS name FROM orders) o ON name = boss
    WHERE name IS NULL OR name = ''""")
def join_full_filtered(t):
    people = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("boss"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    bosses = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", name).alias("name"))
    return J.unmatched_full(people, bosses, "boss", "name").select("c_custkey", "boss", "o_orderkey", "name")


@query("join_null_safe", """
    SELECT o_orderkey, r_name FROM (SELECT o_orderkey, nullif(o_orderkey % 5, 3) AS k FROM orders) o
    JOIN (SELECT r_name, nullif(r_regionkey, 3) AS k FROM region) r ON o.k IS NOT DISTINCT FROM r.k""")
def join_null_safe(t):
    left = t.orders.select("o_orderkey", F.nullif(F.col("o_orderkey") % 5, F.lit(3)).alias("k"))
    right = t.region.select("r_name", F.nullif("r_regionkey", F.lit(3)).alias("k2"))
    return left.join(right, left["k"].eqNullSafe(right["k2"])).select("o_orderkey", "r_name")


@query("join_case_insensitive", """
    SELECT c_custkey, n_name FROM (SELECT c_custkey, lower(n.n_name) AS home FROM customer
      JOIN nation n ON c_nationkey = n.n_nationkey) c JOIN nation ON upper(home) = upper(n_name)""")
def join_case_insensitive(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.lower("n_name").alias("home"))
    names = t.nation.select("n_name")
    return homes.join(names, F.upper("home") == F.upper("n_name")).select("c_custkey", "n_name")


@query("join_cross", """
    SELECT * FROM (SELECT DISTINCT o_custkey FROM orders), (SELECT CAST(unnest(generate_series(DATE '2001-05-01',
      DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS day)""")
def join_cross(t):
    """Partitions × dates: the fixed calendar is exploded on each distinct key, in place."""
    days = F.sequence(F.lit("2001-05-01").cast("date"), F.lit("2001-08-01").cast("date"))
    return t.orders.select("o_custkey").distinct().select("o_custkey", F.explode(days).alias("day"))


@query("join_self_lookup", """
    SELECT c_custkey, boss AS manager, CASE WHEN boss IS NOT NULL THEN last_segment END AS manager_email
    FROM (SELECT c_custkey, 'n' || (c_nationkey - 1) AS m FROM customer) p
    LEFT JOIN (SELECT 'n' || c_nationkey AS boss, arg_max(c_mktsegment, c_custkey) AS last_segment
               FROM customer GROUP BY c_nationkey) ON m = boss""")
def join_self_lookup(t):
    people = t.customer.select(
        "c_custkey", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("own"),
        F.concat(F.lit("n"), (F.col("c_nationkey") - 1).cast("string")).alias("m"), "c_mktsegment")
    return J.self_manager(people, "own", "m", "c_mktsegment", "c_custkey").select("c_custkey", "manager", "manager_email")


@query("join_anti_existing", """
    SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')""")
def join_anti_existing(t):
    known = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.new_rows(t.orders.select("o_orderkey", "o_totalprice"), known, ["o_orderkey"])


@query("join_anti_null_keys", """
    SELECT o_orderkey, k FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS k FROM orders) o
    WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('F'), (NULL)) v(k) WHERE v.k IS NOT DISTINCT FROM o.k)""")
def join_anti_null_keys(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("k"))
    known = t.spark.createDataFrame([("F",), (None,)], "k STRING")
    return J.new_rows(rows, known, ["k"])


@query("join_semi_periods", """
    SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) IN (
      SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 5)""")
def join_semi_periods(t):
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))
    busy = rows.filter("event_type = 'error'").groupBy("day").count().filter("count > 5")
    return rows.join(busy, "day", "left_semi").select("event_id", "day")


def people(t):
    """The customers as a person directory."""
    return t.customer.select(
        F.sha1(F.encode("c_name", "utf-8")).alias("guid"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@x.org")).alias("email"),
        F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("alias"), F.col("c_name").alias("displayName"),
        F.concat(F.lit("Customer#"), F.lpad(F.floor(F.col("c_custkey") / 10).cast("string"), 9, "0")).alias("manager"))


@query("join_lookup_guid", """
    SELECT o_orderkey, sha1(c_name) AS guid FROM orders JOIN customer ON o_custkey + 100 = c_custkey""")
def join_lookup_guid(t):
    rows = t.orders.select("o_orderkey", F.concat(F.lit("a"), (F.col("o_custkey") + 100).cast("string")).alias("alias"))
    return J.resolve_person(rows, people(t), "alias").drop("alias")


@query("lookup_manager", """
    SELECT o_orderkey, coalesce('Customer#' || lpad(CAST(c_custkey // 10 AS VARCHAR), 9, '0'), '') AS manager
    FROM orders LEFT JOIN customer ON o_custkey + 100 = c_custkey""")
def lookup_manager(t):
    rows = t.orders.select("o_orderkey", F.concat(F.lit("a"), (F.col("o_custkey") + 100).cast("string")).alias("alias"))
    return J.lookup_manager(rows, people(t), "alias").drop("alias")


@query("join_dimension_map", """
    SELECT o_orderkey, CASE WHEN b IS NULL THEN n_name ELSE r_name END AS customer,
           CASE WHEN b IS NULL THEN o_orderpriority ELSE 'mapped' END AS work_order
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT DISTINCT n_name AS a, '1-URGENT' AS b, r_name FROM nation JOIN region
               ON n_regionkey = r_regionkey) ON a = n.n_name AND b = o_orderpriority""")
def join_dimension_map(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    rows = t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("n_name").alias("customer"), F.col("o_orderpriority").alias("work_order"))
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("old"), F.lit("1-URGENT").alias("old_order"), F.col("r_name").alias("new"),
        F.lit("mapped").alias("new_order"))
    return J.map_dimension(rows, mapping.unionByName(mapping), {"customer": "old", "work_order": "old_order"},
                           {"customer": "new", "work_order": "new_order"})


@query("join_agg_latest", """
    SELECT e.event_id, e.user_id, e.ts FROM events e JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id) m
    ON e.user_id = m.user_id AND e.ts = m.ts""")
def join_agg_latest(t):
    return latest(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts")


@query("correlated_max", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders a WHERE o_orderdate = (
      SELECT max(o_orderdate) FROM orders b WHERE a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus)""")
def correlated_max(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return latest(rows, ["o_custkey", "o_orderstatus"], "o_orderdate")


@query("join_two_aggregates", """
    SELECT a.l_suppkey, a.l_returnflag, qty, late FROM
      (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2) a
      LEFT JOIN (SELECT l_suppkey, l_returnflag, round(avg(l_discount), 6) AS late FROM lineitem
                 WHERE l_linestatus = 'F' GROUP BY 1, 2) b
      ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag""")
def join_two_aggregates(t):
    """Two aggregates over one key become one pass with a conditional measure."""
    late = F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_discount")))
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("qty"),
                                                               cents(late, 6).alias("late"))


@query("join_two_aggregates_inner", """
    SELECT a.p_brand, a.p_type, parts, price FROM
      (SELECT p_brand, p_type, count(*) AS parts FROM part GROUP BY 1, 2) a
      JOIN (SELECT p_brand, p_type, max(p_retailprice) AS price FROM part WHERE p_size > 40 GROUP BY 1, 2) b
      ON a.p_brand = b.p_brand AND a.p_type = b.p_type""")
def join_two_aggregates_inner(t):
    parts = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("parts"))
    price = t.part.filter("p_size > 40").groupBy("p_brand", "p_type").agg(F.max("p_retailprice").alias("price"))
    return parts.join(price, ["p_brand", "p_type"])


@query("join_label", """
    SELECT o_orderkey, f.frequency FROM orders
    JOIN (VALUES (1,'daily'),(2,'weekly'),(3,'monthly'),(4,'yearly')) f(id, frequency) ON f.id = o_orderkey % 6""")
def join_label(t):
    rows = t.orders.select(F.col("o_orderkey").alias("repo"), (F.col("o_orderkey") % 6).cast("int").alias("class"))
    return with_label(rows, frequency_labels(t.spark)).withColumnRenamed("repo", "o_orderkey")


@query("join_channel_name", """
    SELECT event_id, c.name AS channel_name FROM events LEFT JOIN (
      SELECT event_type AS channel, 'ch-' || upper(event_type) AS name FROM events WHERE event_type <> 'view'
      GROUP BY event_type) c ON channel = event_type""")
def join_channel_name(t):
    names = t.events.filter("event_type <> 'view'").select(
        F.col("event_type").alias("channel"), F.concat(F.lit("ch-"), F.upper("event_type")).alias("channel_name"))
    return with_channel_names(t.events.select("event_id", F.col("event_type").alias("channel")), names).drop("channel")
