"""§ streaming. Each query lands whole tables as files, runs the stream twice and reads the result.

The second run sees the whole feed again or nothing new; either way the result must not change.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..functions import presto as P
from ..functions import signature as S
from ..operators.governance import upsert
from ..plans import catalogue, feeds
from ..plans.job import Context
from ..plans.registry import stored_sql
from ..session import new_folder
from ..sources.envelopes import wrap, write_envelopes
from ..sources.incremental import incremental
from ..streaming import jobs as J
from ..tables.store import TableStore
from .governance import DAY, sizes_sql, stored_tables
from .registry import ORACLES, query
from .source_jobs import EMOJI_SQL, chat_bodies

SECRET = "top secret"


def stream_of(t, folder, schema):
    return t.spark.readStream.schema(schema).parquet(folder)


def land(df, folder):
    df.write.mode("append").parquet(folder)


@query("stream_ingest_process", """
    SELECT event_id, calendar_id, timestamp_from, CAST(run AS BIGINT) AS time FROM (
      SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS calendar_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_from,
             CASE event_type WHEN 'view' THEN 2 ELSE 1 END AS run FROM events)""")
def stream_ingest_process(t):
    raw, checkpoint = new_folder(t.spark, "raw"), new_folder(t.spark, "stream")
    store = TableStore(t.spark, new_folder(t.spark, "zone"))
    context = Context(t.spark, datetime(2024, 2, 1, tzinfo=timezone.utc), store)
    record = F.array(F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("calendar_id"),
                              F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp_from")))
    for run, kinds in ((1, "event_type <> 'view'"), (2, "event_type = 'view'")):
        write_envelopes(wrap(t.events.filter(kinds), record, F.lit(run)), raw)
        J.ingest_process(t.spark, raw, feeds.calendar, context, checkpoint)
    J.ingest_process(t.spark, raw, feeds.calendar, context, checkpoint)
    return store.read("google_calendar_events").select("event_id", "calendar_id", "timestamp_from", "time")


@query("stream_dedupe_existing", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag <> 'R', l_linenumber, l_partkey, l_quantity, l_returnflag) AS place
      FROM lineitem) WHERE place = 1""")
def stream_dedupe_existing(t):
    """Returned lines first, then all lines: an order known from the first landing keeps the line it had."""
    feed, target, checkpoint = (new_folder(t.spark, x) for x in ("feed", "target", "stream"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    for part in (rows.filter("l_returnflag = 'R'"), rows):
        land(part, feed)
        J.dedupe_existing(stream_of(t, feed, rows.schema), ["l_orderkey"], target, checkpoint)
    return J.read_batches(t.spark, target)


@query("stream_emoji_events", f"""
    SELECT event_type, channel, channel_name, event_ts, team_id, emoji FROM (
      SELECT * REPLACE (CAST(NULL AS VARCHAR) AS channel_name) FROM ({EMOJI_SQL}))""")
def stream_emoji_events(t):
    feed, target, checkpoint = (new_folder(t.spark, x) for x in ("feed", "target", "stream"))
    bodies = chat_bodies(t).select("body")
    land(bodies, feed)
    for _ in range(2):
        J.append(J.emoji_events(stream_of(t, feed, bodies.schema), "body"), target, checkpoint)
    return t.spark.read.parquet(target)


@query("stream_signature_filter", """
    SELECT event_id, event_type <> 'error' AND event_type <> 'view' AS valid FROM events""")
def stream_signature_filter(t):
    """Errors arrive unsigned, views with a wrong signature."""
    feed, good, bad, checkpoint = (new_folder(t.spark, x) for x in ("feed", "good", "bad", "stream"))
    ts = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    right = S.chat_signature(ts, "props", SECRET)
    sent = F.when(F.col("event_type") == "view", F.concat(F.lit("v0="), F.sha2("props", 256))) \
        .when(F.col("event_type") != "error", right)
    rows = t.events.select("event_id", F.concat(F.lit(" "), "props", F.lit(" ")).alias("body"), ts.alias("timestamp"),
                           sent.alias("signature"))
    land(rows, feed)
    for _ in range(2):
        J.split_signed(J.signed(stream_of(t, feed, rows.schema), SECRET), good, bad, checkpoint)
    return J.read_batches(t.spark, good).select("event_id", F.lit(True).alias("valid")).unionByName(
        J.read_batches(t.spark, bad).select("event_id", F.lit(False).alias("valid")))


@query("stream_highwater", """
    SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-12' THEN 1 ELSE 2 END AS run FROM events
    WHERE ts < TIMESTAMP '2024-01-25'""")
def stream_highwater(t):
    """Two polls with a marks table between them: together they read each event once."""
    marks = t.spark.createDataFrame([], "source STRING, mark TIMESTAMP_NTZ")
    folder, parts = new_folder(t.spark, "marks"), []
    for run, now in ((1, "2024-01-12"), (2, "2024-01-25")):
        rows, after = incremental(t.events, marks, "event_type", "ts", F.expr(f"timestamp_ntz'{now}'"))
        parts.append(rows.select("event_id", F.lit(run).alias("run")))
        after.write.parquet(f"{folder}/{run}")
        marks = t.spark.read.parquet(f"{folder}/{run}")
    return parts[0].unionByName(parts[1])


@query("late_period_rule", """
    WITH landed AS (
      SELECT isoyear(o_orderdate) || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS reg_period, o_orderstatus = 'F' AS b,
             CAST(o_orderkey AS VARCHAR) AS used_hrs, CAST(date_trunc('week', o_orderdate) AS DATE) + 7 AS ends,
             CASE WHEN o_orderdate < DATE '1997-06-01' AND o_orderpriority <> '5-LOW' THEN 1
                  WHEN o_orderdate < DATE '1999-06-01' AND o_orderpriority <> '4-NOT SPECIFIED' THEN 2 ELSE 3 END AS landing
      FROM orders),
    marks AS (SELECT k AS landing, max(ends) - 28 AS mark FROM landed, (VALUES (1), (2), (3)) AS v(k) WHERE landing <= k GROUP BY k),
    closing AS (
      SELECT reg_period, greatest(min(landing), (SELECT min(m.landing) FROM marks m WHERE m.mark >= p.ends)) AS landing
      FROM landed p WHERE b GROUP BY reg_period, ends HAVING (SELECT max(mark) FROM marks) >= ends)
    SELECT l.reg_period, min(used_hrs) FILTER (l.landing <= c.landing) AS used_hrs, count(*) FILTER (l.landing > c.landing) AS late
    FROM landed l JOIN closing c ON c.reg_period = l.reg_period WHERE b GROUP BY 1""")
def late_period_rule(t):
    """Three landings, each with rows of periods that the earlier ones have closed."""
    feed, target, aside, checkpoint = (new_folder(t.spark, x) for x in ("feed", "target", "aside", "stream"))
    landing = F.when(F.expr("o_orderdate < '1997-06-01' AND o_orderpriority <> '5-LOW'"), 1).when(
        F.expr("o_orderdate < '1999-06-01' AND o_orderpriority <> '4-NOT SPECIFIED'"), 2).otherwise(3)
    landed = t.orders.select(
        P.iso_period("o_orderdate").alias("reg_period"), F.col("o_orderkey").cast("string").alias("used_hrs"),
        F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 7).alias("ends"),
        F.when(F.col("o_orderstatus") == "F", "B").otherwise("N").alias("tab"), landing.alias("landing"))
    rows = landed.drop("landing")
    for n in (1, 2, 3):
        land(landed.filter(F.col("landing") == n).drop("landing"), feed)
        J.late_periods(stream_of(t, feed, rows.schema), "reg_period", "ends", target, aside, checkpoint, "28 days", F.col("tab") == "B")
    late = J.read_batches(t.spark, aside).groupBy("reg_period").agg(F.sum("late").alias("late"))
    return J.read_batches(t.spark, target).select("reg_period", "used_hrs").join(late, "reg_period", "left").select(
        "reg_period", "used_hrs", F.coalesce("late", F.lit(0)).alias("late"))


STREAMED = ("workExperience", "workExperienceDistributedInYears", "employeeInformation", "employeeProfileInformation", "fullProfile4",
            "fullProfile7", "yearsSinceSchoolDist", "degreeDist")


@query("stream_refresh_reports", f"""
    SELECT name, n, 1 AS batch FROM ({sizes_sql(STREAMED[:2])}) UNION ALL SELECT name, n, 2 FROM ({sizes_sql(STREAMED[2:])})
    UNION ALL SELECT 'degrees', (SELECT count(*) FROM ({ORACLES["r_degree_distribution"]})), 2""")
def stream_refresh_reports(t):
    """Rows of orders and parts announce that the tables made of them changed; the reports over these, and over those reports, are recomputed once per batch."""
    feed, checkpoint = new_folder(t.spark, "feed"), new_folder(t.spark, "stream")
    store = TableStore(t.spark, new_folder(t.spark, "reports"))
    stored_tables(t, store)
    more = t.spark.createDataFrame([("degrees", "SELECT * FROM degreeDist", ["degreeDist"], 3, "2024-02-01", None, None)], catalogue.REGISTRY)
    registry = upsert(catalogue.registry(t.spark, lambda table: 2, "2024-01-01"), more)
    out = None
    for batch, (rows, table) in enumerate([(t.orders, "cv_partner_work_experience"), (t.part, "cv_partner_education")], 1):
        changes = rows.select(F.lit(table).alias("table"))
        land(changes, feed)
        names = J.refresh_reports(stream_of(t, feed, changes.schema), store, lambda: registry, stored_sql(store, DAY), "2024-03-03", checkpoint)
        for name in names:
            one = store.cached_report(name, 3).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n", F.lit(batch).alias("batch"))
            out = one if out is None else out.unionByName(one)
    return out
