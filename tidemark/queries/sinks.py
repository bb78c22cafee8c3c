"""§ sinks and table maintenance. Each query writes whole tables to a fresh folder and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_folder
from ..sources.envelopes import read_envelopes, wrap, write_envelopes
from ..tables.export import export
from ..tables.store import TableStore, level_database, verify_schema
from .registry import Tables, cents, query


def store_of(t: Tables) -> TableStore:
    return TableStore(t.spark, new_folder(t.spark, "store"))


@query("write_envelope", "SELECT event_id, user_id, event_type, value FROM events")
def write_envelope(t):
    path = new_folder(t.spark, "raw")
    landed = wrap(t.events, F.struct("event_id", "user_id", "event_type", "value"),
                  F.unix_timestamp(F.col("ts").cast("timestamp")))
    write_envelopes(landed, path)
    write_envelopes(landed, path, overwrite=True)
    return read_envelopes(t.spark, path, "STRUCT<event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE>") \
        .select("data.*")


@query("table_append", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def table_append(t):
    store, rows = store_of(t), t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    store.write(rows.filter("o_orderstatus = 'F'"), "orders", ["o_orderstatus"])
    store.write(rows.filter("o_orderstatus <> 'F'"), "orders", ["o_orderstatus"])
    return store.read("orders")


@query("table_overwrite", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders")
def table_overwrite(t):
    """The second write reads the table it replaces."""
    store = store_of(t)
    store.write(t.orders.select("o_orderkey", "o_totalprice"), "orders", overwrite=True)
    newer = store.read("orders").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    store.write(newer, "orders", overwrite=True)
    return store.read("orders")


@query("table_purge_versions", """
    SELECT 'after change' AS step, CAST(1 AS INTEGER) AS archived, count(*) AS n FROM orders
    UNION ALL SELECT 'after purge', 0, count(*) FROM orders""")
def table_purge_versions(t):
    store = store_of(t)
    store.write(t.orders.select("o_orderkey"), "orders")
    store.write(t.orders.select("o_orderkey", "o_custkey"), "orders")
    changed = len(store.archived("orders"))
    first = store.read("orders").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("after change").alias("step"), F.lit(changed).alias("archived"), "n").collect()
    store.write(t.orders.select("o_orderkey", "o_custkey"), "orders", overwrite=True, purge_versions=True)
    purged = store.read("orders").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("after purge").alias("step"), F.lit(len(store.archived("orders"))).alias("archived"), "n")
    return t.spark.createDataFrame(first, purged.schema).unionByName(purged)


@query("historical_append", """
    SELECT o_orderkey, o_totalprice, 1 AS run FROM orders UNION ALL
    SELECT o_orderkey, o_totalprice, 2 FROM orders""")
def historical_append(t):
    store = store_of(t)
    for run in (1, 2):
        store.write(t.orders.select("o_orderkey", "o_totalprice", F.lit(run).alias("run")), "orders", overwrite=True,
                    purge_versions=True, historical=True)
    return store.read("orders")


@query("verify_schema", """
    SELECT c.name AS "case", c.ok AS matches, n.n AS stored_rows
    FROM (SELECT count(*) AS n FROM orders) n,
         (VALUES ('same', true), ('reordered', true), ('column missing', false), ('column added', false),
                 ('column renamed', false), ('type changed', false), ('partition added', false),
                 ('partition changed', false), ('partition dropped', false)) c(name, ok)""")
def verify_schema_query(t):
    store, rows = store_of(t), t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    store.write(rows, "orders", ["o_orderstatus"])
    old, parts = store.read("orders"), store.partitions("orders")
    frames = {
        "same": (rows, ["o_orderstatus"]),
        "reordered": (rows.select("o_orderstatus", "o_totalprice", "o_orderkey", "o_custkey"), ["o_orderstatus"]),
        "column missing": (rows.drop("o_custkey"), ["o_orderstatus"]),
        "column added": (rows.withColumn("more", F.lit(1)), ["o_orderstatus"]),
        "column renamed": (rows.withColumnRenamed("o_custkey", "cust"), ["o_orderstatus"]),
        "type changed": (rows.withColumn("o_custkey", F.col("o_custkey").cast("double")), ["o_orderstatus"]),
        "partition added": (rows, ["o_orderstatus", "o_custkey"]),
        "partition changed": (rows, ["o_custkey"]),
        "partition dropped": (rows, []),
    }
    cases = [(name, verify_schema(old.schema, parts, df.schema, new)) for name, (df, new) in frames.items()]
    names = F.array(*[F.struct(F.lit(n).alias("case"), F.lit(ok).alias("matches")) for n, ok in cases])
    return old.agg(F.count(F.lit(1)).alias("stored_rows")).select(F.inline(names), "stored_rows")


@query("archive_on_change", """
    SELECT 'archived' AS zone, o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
    UNION ALL SELECT 'current', o_orderkey, o_orderpriority FROM orders""")
def archive_on_change(t):
    store = store_of(t)
    store.write(t.orders.select("o_orderkey"), "orders")
    store.write(t.orders.select("o_orderkey", "o_orderpriority"), "orders")
    old = store.read_archived("orders", store.archived("orders")[0])
    return (old.select(F.lit("archived").alias("zone"), "o_orderkey", F.lit(None).cast("string").alias("o_orderpriority"))
            .unionByName(store.read("orders").select(F.lit("current").alias("zone"), "o_orderkey", "o_orderpriority")))


@query("fill_partition_nulls", """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'undefined') AS status,
           CAST(coalesce(nullif(CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 2), -1) AS VARCHAR) AS rank
    FROM orders""")
def fill_partition_nulls_query(t):
    store = store_of(t)
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"),
                           F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(2)).alias("rank"))
    store.write(rows, "orders", ["status", "rank"])
    return store.read("orders").select("o_orderkey", "status", "rank")


@query("skip_empty", """
    SELECT 'full' AS "table", true AS written, (SELECT count(*) FROM orders) AS n
    UNION ALL SELECT 'empty', false, 0 UNION ALL SELECT 'missing', false, 0""")
def skip_empty(t):
    store, outputs = store_of(t), {"full": t.orders, "empty": t.orders.filter("o_totalprice < 0"), "missing": None}
    store.write_all(outputs)
    parts = []
    for name in outputs:
        n = store.read(name).agg(F.count(F.lit(1)).alias("n")) if store.exists(name) else \
            t.orders.filter("o_totalprice < 0").agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.lit(name).alias("table"), F.lit(store.exists(name)).alias("written"), "n"))
    return parts[0].union(parts[1]).union(parts[2])


@query("multi_table_write", """
    SELECT 'customer_dim' AS "table", count(*) AS n FROM customer UNION ALL
    SELECT 'customer_fact', count(*) FROM customer UNION ALL
    SELECT 'nation_count', count(DISTINCT c_nationkey) FROM customer""")
def multi_table_write(t):
    store = store_of(t)
    names = store.write_all({
        "customer_dim": t.customer.select("c_custkey", "c_name", "c_nationkey"),
        "customer_fact": t.customer.select("c_custkey", "c_acctbal"),
        "nation_count": t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")),
    }, {"customer_dim": ["c_nationkey"]}, overwrite=True)
    counts = [store.read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n") for n in names]
    return counts[0].union(counts[1]).union(counts[2])


@query("register_table", """
    SELECT 'appended' AS step, o_orderstatus, count(*) AS n, false AS added_again, CAST(NULL AS DOUBLE) AS total FROM orders
    GROUP BY o_orderstatus
    UNION ALL SELECT 'changed', o_orderstatus, count(*), false, round(sum(o_totalprice), 2) FROM orders GROUP BY o_orderstatus""")
def register_table(t):
    """Registered, a partition appended, then the schema changed: SQL sees what is stored each time."""
    store = store_of(t)
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    database = level_database("t" + store.root[-8:], 2)
    store.write(rows.drop("o_totalprice").filter("o_orderstatus <> 'P'"), "orders", ["o_orderstatus"])
    store.register("orders", database)
    store.write(rows.drop("o_totalprice").filter("o_orderstatus = 'P'"), "orders", ["o_orderstatus"])
    again = F.lit(store.register("orders", database)).alias("added_again")
    appended = t.spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {database}.orders GROUP BY o_orderstatus")
    kept = store_of(t)  # as it was seen then
    kept.write(appended.select("*", again), "appended")
    appended = kept.read("appended")
    store.write(rows, "orders", ["o_orderstatus"])
    again = F.lit(store.register("orders", database)).alias("added_again")
    changed = t.spark.sql(f"SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {database}.orders "
                          "GROUP BY o_orderstatus")
    return appended.select(F.lit("appended").alias("step"), "*", F.lit(None).cast("double").alias("total")).unionByName(
        changed.select(F.lit("changed").alias("step"), "*", again))


@query("report_materialize", """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority""")
def report_materialize(t):
    store = store_of(t)
    report = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                                     cents(F.sum("o_totalprice")).alias("total"))
    store.materialize("priorities", report.limit(0), 3)
    store.materialize("priorities", report, 3)
    return store.cached_report("priorities", 3)


@query("export_result", """
    WITH n AS (SELECT n_nationkey, nullif(n_name, 'NATION_3') AS n_name, count(c_custkey) AS customers
               FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name)
    SELECT 'json' AS format, CAST(to_json(n) AS VARCHAR) AS value FROM n
    UNION ALL SELECT 'csv', 'n_nationkey,n_name,customers'
    UNION ALL SELECT 'csv', n_nationkey || ',' || coalesce(n_name, '') || ',' || customers FROM n""")
def export_result(t):
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("c"))
    rows = t.nation.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_nationkey", F.nullif("n_name", F.lit("NATION_3")).alias("n_name"),
        F.coalesce("c", F.lit(0)).alias("customers"))
    return (export(rows, "json").select(F.lit("json").alias("format"), "value")
            .union(export(rows, "csv").select(F.lit("csv").alias("format"), "value")))


@query("snapshot_replace", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'")
def snapshot_replace(t):
    store = store_of(t)
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    store.write(rows.drop("c_mktsegment"), "directory", overwrite=True)
    store.write(rows.filter("c_mktsegment <> 'BUILDING'").drop("c_mktsegment"), "directory", overwrite=True)
    return store.read("directory")
