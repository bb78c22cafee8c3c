"""§ scalar functions and the user-function surface."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import presto as P
from ..functions import signature as S
from ..plans.job import Context, job
from ..session import new_folder
from ..sources.envelopes import with_meta_time, wrap
from ..tables.export import filters_from_text
from ..tables.store import TableStore
from .joins import people
from .registry import cents, query

WORDS = ["small", "large", "red", "blue", "bolt", "ring", "widget", "gear", "nut", "valve", "steel", "brass",
           "green", "cog", "pin", "cap", "rod", "hub", "tube", "belt", "plate"]


@query("scalar_substr", """
    SELECT l_orderkey, l_linenumber, substr(p, 1, 4) AS year, substr(p, 5, 6) AS week FROM (
      SELECT *, isoyear(l_shipdate) || CAST(week(l_shipdate) AS VARCHAR) AS p FROM lineitem)""")
def scalar_substr(t):
    p = F.concat(P.iso_year("l_shipdate").cast("string"), P.iso_week("l_shipdate").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.substring(p, 1, 4).alias("year"),
                             F.substring(p, 5, 6).alias("week"))


@query("scalar_like_chain", f"""
    SELECT doc_id, ({' OR '.join(f"lower(text) LIKE '%{w}%'" for w in WORDS)}) AS hit FROM documents""")
def scalar_like_chain(t):
    return t.documents.select("doc_id", reduce(lambda a, b: a | b, [F.lower("text").contains(w) for w in WORDS]).alias("hit"))


@query("scalar_upper_concat", """
    SELECT c_custkey, upper(c_mktsegment) || '-' || CAST(c_nationkey AS VARCHAR) AS label FROM customer""")
def scalar_upper_concat(t):
    return t.customer.select("c_custkey", F.concat(F.upper("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string"))
                             .alias("label"))


@query("scalar_text", r"""
    SELECT page_id, lower(url) AS low, string_split(url, '/')[3] AS host, starts_with(url, 'https') AS secure,
           regexp_replace(url, '[0-9]', '#', 'g') AS masked, array_to_string(string_split(url, '/'), ';') AS parts
    FROM pages""")
def scalar_text(t):
    parts = F.split("url", "/")
    return t.pages.select("page_id", F.lower("url").alias("low"), F.element_at(parts, 3).alias("host"),
                          F.col("url").startswith("https").alias("secure"),
                          F.regexp_replace("url", "[0-9]", "#").alias("masked"), F.array_join(parts, ";").alias("parts"))


@query("scalar_value_partition", """
    SELECT page_id, split_part(url, ':', 1) AS field, substr(url, instr(url, ':') + 1) AS value FROM pages""")
def scalar_value_partition(t):
    parts = F.split("url", ":", 2)
    return t.pages.select("page_id", parts[0].alias("field"), parts[1].alias("value"))


def hmac_sql(message: str, key: str) -> str:
    """HMAC-SHA256 composed from plain hashing, to check the native expression."""
    inner, outer = (p.hex() for p in S._pads(key))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


@query("scalar_hash", f"""
    SELECT event_id, sha1(event_type) AS guid, {hmac_sql("props", "top secret")} AS signature FROM events""")
def scalar_hash(t):
    return t.events.select("event_id", C.stable_guid("event_type").alias("guid"),
                           S.hmac_hex("props", "top secret").alias("signature"))


@query("scalar_date_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
           CAST(day(o_orderdate) AS INTEGER) AS d, CAST(week(o_orderdate) AS INTEGER) AS w FROM orders""")
def scalar_date_parts(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                           F.day("o_orderdate").alias("d"), F.weekofyear("o_orderdate").alias("w"))


@query("scalar_from_unixtime", """
    SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds, CAST(o_orderdate AS DATE) AS day FROM orders""")
def scalar_from_unixtime(t):
    seconds = P.to_unixtime("o_orderdate")
    return t.orders.select("o_orderkey", seconds.alias("seconds"), F.to_date(P.from_unixtime(seconds)).alias("day"))


@query("scalar_date_add", """
    SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)) AS at,
           strptime('Jan-01-' || year(ts), '%b-%d-%Y') AS new_year FROM events""")
def scalar_date_add(t):
    ts = F.col("ts").cast("timestamp")
    return t.events.select("event_id", F.timestamp_seconds(F.unix_timestamp(ts)).alias("at"),
                           F.to_timestamp(F.concat(F.lit("Jan-01-"), F.year(ts).cast("string")), "MMM-dd-yyyy")
                           .alias("new_year"))


@query("scalar_interval", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 YEAR AS DATE) AS before,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS quarter FROM orders""")
def scalar_interval(t):
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.add_months(day, -36).alias("before"), F.add_months(day, -3).alias("quarter"))


@query("scalar_date_diff", """
    SELECT l_orderkey, l_linenumber, CAST(date_sub('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
           AS months FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def scalar_date_diff(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber",
                       P.complete_months(F.to_date("o_orderdate"), F.to_date("l_shipdate")).alias("months"))


@query("scalar_sequence", """
    SELECT event_id, CAST(unnest(generate_series(CAST(ts AS DATE) - INTERVAL 2 DAY, CAST(ts AS DATE), INTERVAL 1 DAY))
           AS DATE) AS day FROM events""")
def scalar_sequence(t):
    day = F.to_date("ts")
    return t.events.select("event_id", F.explode(F.sequence(F.date_sub(day, 2), day)).alias("day"))


@query("scalar_event_time", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT)
           ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS at FROM events""")
def scalar_event_time(t):
    ts = F.col("ts").cast("timestamp")
    timed = F.when(F.col("event_type") != "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX"))
    when = F.struct(timed.alias("dateTime"), F.date_format(ts, "yyyy-MM-dd").alias("date"))
    return t.events.select("event_id", when.alias("w")).select("event_id", C.start_or_date("w").alias("at"))


@query("scalar_isocalendar", """
    SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INTEGER) AS y, CAST(week(o_orderdate) AS INTEGER) AS w FROM orders""")
def scalar_isocalendar(t):
    return t.orders.select("o_orderkey", P.iso_year("o_orderdate").alias("y"), P.iso_week("o_orderdate").alias("w"))


ISO_SQL = """
    SELECT event_id, date_trunc('second', ts) AS at, CAST(ts AS DATE) AS day,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
           date_trunc('second', ts) AS back FROM events"""


@query("scalar_iso8601", ISO_SQL)
def scalar_iso8601(t):
    rows = t.events.select("event_id", P.to_iso8601(F.col("ts").cast("timestamp")).alias("text"))
    seconds = P.to_unixtime(P.from_iso8601_timestamp("text"))
    return rows.select("event_id", P.from_iso8601_timestamp("text").alias("at"), P.from_iso8601_date(
        F.substring("text", 1, 10)).alias("day"), "text", seconds.alias("seconds"), P.from_unixtime(seconds).alias("back"))


@query("sql_functions", ISO_SQL)
def sql_functions(t):
    """The same through SQL text."""
    P.register_sql_functions(t.spark)
    return t.spark.sql("""
        SELECT event_id, from_iso8601_timestamp(text) AS at, from_iso8601_date(substr(text, 1, 10)) AS day, text,
               to_unixtime(from_iso8601_timestamp(text)) AS seconds,
               from_epoch(to_unixtime(from_iso8601_timestamp(text))) AS back
        FROM (SELECT event_id, to_iso8601(CAST(ts AS TIMESTAMP)) AS text FROM {e})""", e=t.events)


@query("scalar_math", """
    SELECT l_orderkey, l_linenumber, l_partkey // 12 AS dozens, round(100 * CAST(l_partkey AS DOUBLE) / CAST(l_suppkey + 1
           AS DOUBLE), 6) AS share FROM lineitem""")
def scalar_math(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.expr("l_partkey div 12").alias("dozens"),
                             cents(100 * F.col("l_partkey").cast("double") / (F.col("l_suppkey") + 1).cast("double"), 6)
                             .alias("share"))


@query("scalar_try", """
    SELECT o_orderkey, TRY_CAST('2021-2-' || (o_orderkey % 35) AS DATE) AS day, TRY_CAST(o_orderstatus AS INTEGER) AS n,
           coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 0) AS rank,
           CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS size FROM orders""")
def scalar_try(t):
    return t.orders.select(
        "o_orderkey", F.concat(F.lit("2021-2-"), (F.col("o_orderkey") % 35).cast("string")).try_cast("date").alias("day"),
        F.col("o_orderstatus").try_cast("int").alias("n"),
        F.coalesce(F.substring("o_orderpriority", 1, 1).try_cast("int"), F.lit(0)).alias("rank"),
        F.expr("if(o_totalprice > 200000, 'large', 'small')").alias("size"))


@query("scalar_array", """
    SELECT doc_id, string_split(text, ' ')[1] AS first, array_to_string(list_sort(list_distinct(
           list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: length(w) > 8))), ';') AS words,
           array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN length(l) > 80 THEN '' ELSE l END),
           ';') AS lines FROM documents""")
def scalar_array(t):
    words = F.filter(F.split(F.regexp_replace("text", "\n", " "), " "), lambda w: F.length(w) > 8)
    lines = F.transform(F.split("text", "\n"), lambda x: F.when(F.length(x) <= 80, x))
    return t.documents.select("doc_id", F.element_at(F.split("text", " "), 1).alias("first"),
                              F.array_join(F.array_sort(F.array_distinct(words)), ";").alias("words"),
                              F.array_join(lines, ";", "").alias("lines"))


@query("scalar_map", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'V' END AS code, 2 AS entries FROM events""")
def scalar_map(t):
    codes = F.map_from_arrays(F.array(F.lit("click"), F.lit("view")), F.array(F.lit("C"), F.lit("V")))
    return t.events.select("event_id", F.element_at(codes, F.col("event_type")).alias("code"),
                           F.size(F.map_values(codes)).alias("entries"))


@query("scalar_json", """
    SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(to_json([event_type, 'x']) AS VARCHAR) AS pair FROM events""")
def scalar_json(t):
    return t.events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"),
                           F.to_json(F.array("event_type", F.lit("x"))).alias("pair"))


@query("scalar_case", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'part' END AS simple,
           CASE WHEN o_totalprice <= 100000 THEN 1 WHEN o_totalprice <= 300000 THEN 2 ELSE 3 END AS searched FROM orders""")
def scalar_case(t):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.when(status == "F", "done").when(status == "O", "open").otherwise("part").alias("simple"),
        F.when(price <= 100000, 1).when(price <= 300000, 2).otherwise(3).alias("searched"))


@query("param_filter", """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""")
def param_filter(t):
    """Named query parameters stay data; `field:value` filters become equality tests."""
    rows = t.spark.sql("SELECT * FROM {o} WHERE o_orderstatus = :status", args={"status": "F"}, o=t.orders)
    for column, value in filters_from_text(["o_orderpriority:2-HIGH"]).items():
        rows = rows.filter(F.col(column) == value)
    return rows.select("o_orderkey", "o_orderpriority")


@job("ARRAY<STRUCT<event_id BIGINT, event_type STRING>>", partitions={"kinds": ["event_type"]}, overwrite=True)
def kinds_job(envelopes, context):
    return {"kinds": with_meta_time(envelopes), "nothing": None}


@query("transform_decorator", """
    SELECT event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS time FROM events""")
def transform_decorator(t):
    context = Context(t.spark, datetime(2024, 2, 1, tzinfo=timezone.utc), TableStore(t.spark, new_folder(t.spark, "job")))
    landed = wrap(t.events, F.array(F.struct("event_id", "event_type")), F.unix_timestamp(F.col("ts").cast("timestamp")))
    kinds_job.run(landed, context)
    return context.store.read("kinds")


@job("ARRAY<STRUCT<o_orderkey BIGINT, alias STRING>>", person_tables={"owned": "alias"})
def owned_job(envelopes, context):
    return {"owned": with_meta_time(envelopes).drop("time")}


@query("person_decorator", """
    SELECT o_orderkey, 'a' || (o_custkey + 100) AS alias, sha1(c_name) AS guid
    FROM orders JOIN customer ON o_custkey + 100 = c_custkey""")
def person_decorator(t):
    alias = F.concat(F.lit("a"), (F.col("o_custkey") + 100).cast("string")).alias("alias")
    landed = wrap(t.orders, F.array(F.struct("o_orderkey", alias)), F.lit(0))
    context = Context(t.spark, store=TableStore(t.spark, new_folder(t.spark, "job")))
    owned_job.run(landed, context, people(t))
    return context.store.read("owned")
