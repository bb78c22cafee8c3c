"""§ scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.flatten import explode_records, explode_scalar, flatten
from ..operators.deployments import FREQUENCY_LABELS
from ..session import new_folder
from ..sources import documents as docs
from ..sources.envelopes import read_envelopes, union_pages, with_meta_time, wrap, write_envelopes
from ..sources.incremental import incremental, newest_group
from ..sources.webhooks import ISSUE_BODY, issue_record
from ..tables.store import TableStore
from .registry import query

PROPS = "STRUCT<k: BIGINT>"


@query("scan_envelope", """
    SELECT event_id, epoch(ts)::DOUBLE AS meta_time, event_type, CAST(props->>'$.k' AS BIGINT) AS k FROM events""")
def scan_envelope(t):
    path = new_folder(t.spark, "raw")
    stamped = t.events.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    write_envelopes(wrap(stamped, F.struct("event_id", F.from_json("props", PROPS).alias("props")),
                         F.col("ts"), F.col("event_type")), path)
    df = read_envelopes(t.spark, path, "STRUCT<event_id BIGINT, props STRUCT<k BIGINT>>")
    return df.select("data.event_id", F.col("metadata.timestamp").alias("meta_time"),
                     F.col("metadata.event_type").alias("event_type"), F.col("data.props.k").alias("k"))


def event_envelopes(t):
    record = F.array(F.struct("event_id", "user_id", "value"))
    return wrap(t.events, record, F.unix_timestamp(F.col("ts").cast("timestamp")))


@query("attach_meta_time", """
    SELECT event_id, user_id, value, CAST(floor(epoch(ts)) AS BIGINT) AS time FROM events""")
def attach_meta_time(t):
    return with_meta_time(event_envelopes(t))


@query("attach_meta_time_float", """
    SELECT event_id, user_id, value, CAST(floor(epoch(ts)) AS DOUBLE) AS time FROM events""")
def attach_meta_time_float(t):
    return with_meta_time(event_envelopes(t), as_float=True)


@query("json_normalize", """
    SELECT c_custkey AS "id", c_name AS "person.name", n_name AS "person.home.nation", r_name AS "person.home.region",
           c_acctbal AS "balance"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def json_normalize(t):
    homes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    nested = t.customer.join(homes, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"),
                 F.struct(F.col("n_name").alias("nation"), F.col("r_name").alias("region")).alias("home"))
        .alias("person"), F.col("c_acctbal").alias("balance"))
    return flatten(nested)


@query("explode_with_meta", r"""
    SELECT conv_id, turn, role, u.line, CAST(len(u.line) AS INTEGER) AS size
    FROM conversations, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line) u""")
def explode_with_meta(t):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("size")))
    return explode_records(t.conversations.withColumn("lines", lines), "lines", ["conv_id", "turn", "role"])


@query("explode_section", r"""
    SELECT doc_id, CAST(i AS INTEGER) AS paragraph_no, parts[i] AS paragraph FROM (
      SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
        SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS parts FROM documents))""")
def explode_section(t):
    parts = F.filter(F.split("text", "\n"), lambda x: x != "")
    section = F.transform(parts, lambda x, i: F.struct((i + 1).alias("paragraph_no"), x.alias("paragraph")))
    return explode_records(t.documents.select("doc_id", section.alias("section")), "section", ["doc_id"])


@query("explode_nested_path", r"""
    SELECT doc_id, word FROM (
      SELECT doc_id, unnest(string_split(sentence, ' ')) AS word FROM (
        SELECT doc_id, unnest(string_split(line, '. ')) AS sentence FROM (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)))
    WHERE length(word) >= 12""")
def explode_nested_path(t):
    sentences = F.flatten(F.transform(F.split("text", "\n"), lambda line: F.split(line, r"\. ")))
    words = F.filter(F.flatten(F.transform(sentences, lambda s: F.split(s, " "))), lambda w: F.length(w) >= 12)
    return explode_scalar(t.spread("documents"), words, "word", ["doc_id"])


@query("read_table", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def read_table(t):
    store = TableStore(t.spark, new_folder(t.spark, "tables"))
    store.write(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "orders", ["o_orderstatus"])
    return store.read("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("read_csv_reference", """
    SELECT o_orderkey, f.frequency FROM orders
    JOIN (VALUES (1,'daily'),(2,'weekly'),(3,'monthly'),(4,'yearly')) f(id, frequency)
      ON f.id = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)""")
def read_csv_reference(t):
    path = new_folder(t.spark, "labels")
    t.spark.createDataFrame(list(FREQUENCY_LABELS.items()), "id INT, frequency STRING").write.csv(path)
    labels = t.spark.read.schema("id INT, frequency STRING").csv(path)
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    return t.orders.join(labels, rank == labels["id"]).select("o_orderkey", "frequency")


def forecast_xml():
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    day = F.coalesce(F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"), F.lit("null"))
    pieces = []
    for i in range(26):
        pieces += [F.lit('<time from="2024-01-'), day, F.lit(f'T{i % 24:02d}:00:00" to="2024-01-'), day,
                   F.lit(f'T{i % 24:02d}:30:00"><precipitation value="'), text(F.col("value")), F.lit('"/><windSpeed mps="'),
                   text((F.col("value") + i).cast("decimal(12,2)")), F.lit('"/><temperature value="'), text(F.col("user_id") + i),
                   F.lit('"/><pressure value="'), text(F.col("event_id")), F.lit('"/></time>')]
    return F.concat(F.lit("<weatherdata><location><name>"), F.col("event_type"), F.lit("</name></location><forecast><tabular>"),
                    *pieces, F.lit("</tabular></forecast></weatherdata>"))


FORECAST_SQL = """
    SELECT 'p/' || user_id AS location, event_type AS location_name,
           CAST(epoch(make_timestamp(2024, 1, day(ts), i % 24, 0, 0)) AS BIGINT) AS time_from,
           CAST(epoch(make_timestamp(2024, 1, day(ts), i % 24, 30, 0)) AS BIGINT) AS time_to,
           value AS precipitation, round(value + i, 2) AS wind_speed, CAST(user_id + i AS INTEGER) AS temperature,
           CAST(event_id AS DOUBLE) AS air_pressure
    FROM events, (SELECT unnest(range(0, 24)) AS i) hours"""


@query("read_xml_rows", FORECAST_SQL)
def read_xml_rows(t):
    place = F.concat(F.lit("p/"), F.col("user_id").cast("string"))
    return docs.forecast_texts(t.spread("events"), forecast_xml(), place).withColumn("wind_speed", F.round("wind_speed", 2))


@query("read_xml_report", """
    SELECT CAST(l_suppkey AS VARCHAR) AS resource_id, CAST(l_quantity AS VARCHAR) AS used_hrs, l_returnflag AS tab
    FROM lineitem""")
def read_xml_report(t):
    """One report file per task, many `AgressoQE` rows each, read back with the row tag."""
    path = new_folder(t.spark, "xml")
    rows = t.lineitem.select(F.col("l_returnflag").alias("tab"), F.col("l_quantity").cast("string").alias("used_hrs"),
                             F.col("l_suppkey").cast("string").alias("resource_id"))
    rows.write.format("xml").option("rootTag", "Agresso").option("rowTag", "AgressoQE").save(path)
    return docs.read_xml(t.spark, path, "AgressoQE", "resource_id STRING, used_hrs STRING, tab STRING")


@query("html_embedded_json", r"""
    SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
           CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS track, url
    FROM pages""")
def html_embedded_json(t):
    """Pages carry no JSON, so what a page's scripts track becomes the marked block that the operator looks for."""
    every = F.transform(docs.scripts("html"), lambda s: F.regexp_extract(s, r"track\((\d+)\)", 1))
    track = F.coalesce(F.get(F.filter(every, lambda x: x != ""), F.lit(0)), F.lit(""))
    block = F.concat(F.lit("<script>// data\nwindow[\"init\"]("),
                     F.to_json(F.struct(F.map_from_arrays(F.array(F.lit("k")), F.array(track)).alias("t"), "url")),
                     F.lit(")</script>"))
    pages = t.pages.select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"),
                           F.concat("html", block).alias("html"))
    found = docs.html_json(pages, "html", "// data\nwindow[\"init\"](", "t MAP<STRING, STRING>, url STRING",
                           ["page_id", "title"])
    return found.select("page_id", "title", F.element_at("json.t", "k").cast("bigint").alias("track"), "json.url")


@query("html_links", r"""
    SELECT page_id, unnest(CASE WHEN len(l) > 0 THEN l ELSE [url] END) AS link FROM (
      SELECT page_id, url, list_distinct(list_filter(
          regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"'']*)["'']', 1), lambda x: x LIKE '/t%')) AS l FROM pages)""")
def html_links(t):
    return t.pages.select("page_id", F.explode(docs.html_links("html", "/t", "url")).alias("link"))


@query("parse_webhook_body", """
    SELECT event_id, event_type, 'K-' || event_id AS issue, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'c' || user_id END
           AS customer, CAST(props->>'$.k' AS VARCHAR) AS issue_status, CAST(floor(epoch(ts)) AS BIGINT) AS created,
           CAST(floor(epoch(ts)) AS BIGINT) + 3600 AS updated
    FROM events""")
def parse_webhook_body(t):
    return issue_bodies(t).select("event_id", *issue_record())


def issue_bodies(t):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    ts = F.col("ts").cast("timestamp")
    labels = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("c"), F.col("user_id").cast("string"))))
    body = F.to_json(F.struct(
        F.concat(F.lit("jira:"), "event_type").alias("webhookEvent"),
        F.struct(F.concat(F.lit("K-"), F.col("event_id").cast("string")).alias("key"), F.struct(
            stamp(ts).alias("created"), stamp(ts + F.expr("INTERVAL 1 HOUR")).alias("updated"),
            F.struct(F.get_json_object("props", "$.k").alias("name")).alias("status"),
            labels.alias("labels")).alias("fields")).alias("issue")))
    return t.events.select("event_id", "ts", F.from_json(body, ISSUE_BODY).alias("b"))


@query("union_pages", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def union_pages_query(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    paths = []
    for status in ("F", "O", "P"):
        paths.append(new_folder(t.spark, f"page-{status}"))
        rows.filter(F.col("o_orderstatus") == status).write.json(paths[-1])
    return union_pages(t.spark, paths, rows.schema)


MARKS = """(VALUES ('click', TIMESTAMP '2024-01-20'), ('view', TIMESTAMP '2024-01-10'),
                   ('none', TIMESTAMP '2024-01-05')) m(source, mark)"""


def event_marks(t):
    return incremental(t.events, t.spark.sql("SELECT * FROM VALUES ('click', TIMESTAMP_NTZ'2024-01-20'), "
                       "('view', TIMESTAMP_NTZ'2024-01-10'), ('none', TIMESTAMP_NTZ'2024-01-05') AS m(source, mark)"),
                       "event_type", "ts", F.expr("TIMESTAMP_NTZ'2024-01-25 12:00:00'"))


@query("incremental_read", f"""
    SELECT event_id, event_type, ts FROM events LEFT JOIN {MARKS} ON m.source = event_type
    WHERE ts >= coalesce(mark, TIMESTAMP '2010-01-01') AND ts < TIMESTAMP '2024-01-25 12:00:00'""")
def incremental_read(t):
    return event_marks(t)[0].select("event_id", "event_type", "ts")


@query("incremental_marks", f"""
    SELECT source, TIMESTAMP '2024-01-25 12:00:00' AS mark FROM (
      SELECT event_type AS source FROM events UNION SELECT source FROM {MARKS})""")
def incremental_marks(t):
    return event_marks(t)[1]


@query("pick_newest_catalog", """
    SELECT event_id, event_type, value FROM events
    WHERE event_type = (SELECT arg_max(event_type, (ts, event_id)) FROM events)""")
def pick_newest_catalog(t):
    newest = newest_group(t.events, "event_type", ["ts", "event_id"])
    return t.events.join(newest, "event_type", "left_semi").select("event_id", "event_type", "value")


@query("scan_person_directory", """
    SELECT sha1(c_name) AS guid, c_name AS "displayName", c_mktsegment AS company FROM customer""")
def scan_person_directory(t):
    return t.customer.select(F.sha1(F.encode("c_name", "utf-8")).alias("guid"), F.col("c_name").alias("displayName"),
                             F.col("c_mktsegment").alias("company"))


@query("scan_cached_report", """
    SELECT CAST(to_json({'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority, 'orders': count(*)}) AS VARCHAR)
           AS value
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' GROUP BY o_orderstatus, o_orderpriority""")
def scan_cached_report(t):
    from ..tables.export import export
    store = TableStore(t.spark, new_folder(t.spark, "reports"))
    store.materialize("by_status", t.orders.groupBy("o_orderstatus", "o_orderpriority")
                      .agg(F.count(F.lit(1)).alias("orders")), 2)
    return export(store.cached_report("by_status", 2, {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}))
