"""§ projection, filter, cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.presto import iso_period
from ..operators.flatten import route, split_dim_fact
from ..operators.forms import answer_list, quiz_grade
from ..operators.grids import bounds, grid_to_rows
from ..sources.webhooks import exclude_accounts as exclude_accounts_of
from ..sources.webhooks import human_message, merged_to_default
from .registry import query


@query("select_rename", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def select_rename(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("balance"))


@query("reindex_columns", """
    SELECT c_name, CAST(NULL AS VARCHAR) AS grade, c_custkey, CAST(NULL AS INTEGER) AS start_year FROM customer""")
def reindex_columns(t):
    return C.reindex(t.customer, {"c_name": "string", "grade": "string", "c_custkey": "bigint", "start_year": "int"})


def words(t):
    """Each document's words mixed with its numbers as text."""
    size = F.col("n_chars").cast("string")
    parts = F.concat(F.split("text", r"\s+"), F.array(size, F.concat(size, F.lit(".75")), F.concat(F.lit("-"), size)))
    return t.spread("documents").select("doc_id", F.explode(parts).alias("word"))


WORDS = r"""
    SELECT doc_id, unnest(list_concat(regexp_split_to_array(text, '\s+'),
           [CAST(n_chars AS VARCHAR), n_chars || '.75', '-' || n_chars])) AS word FROM documents"""
NUMERIC = r"regexp_full_match(word, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')"


@query("to_int_or_zero", f"""
    SELECT doc_id, word, coalesce(CASE WHEN {NUMERIC} THEN TRY_CAST(trunc(TRY_CAST(word AS DOUBLE)) AS INTEGER) END, 0)
           AS n FROM ({WORDS})""")
def to_int_or_zero(t):
    return words(t).select("doc_id", "word", C.int_or_zero("word").alias("n"))


@query("to_float_or_zero", f"""
    SELECT doc_id, word, CAST(coalesce(CASE WHEN {NUMERIC} THEN TRY_CAST(word AS FLOAT) END, 0) AS FLOAT) AS n
    FROM ({WORDS})""")
def to_float_or_zero(t):
    return words(t).select("doc_id", "word", C.float_or_zero("word").alias("n"))


@query("fill_na", """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), '') AS status,
           coalesce(nullif(o_orderpriority, '2-HIGH'), '') AS priority, nullif(o_custkey, 1) AS custkey FROM orders""")
def fill_na(t):
    return C.fill_text(t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("priority"),
        F.nullif("o_custkey", F.lit(1)).alias("custkey")))


@query("blank_to_null", r"""
    SELECT doc_id, CASE WHEN regexp_full_match(line, '\s*') THEN NULL ELSE line END AS line
    FROM (SELECT doc_id, unnest(string_split(text || chr(10) || '  ', chr(10))) AS line FROM documents)""")
def blank_to_null(t):
    lines = t.documents.select("doc_id", F.explode(F.split(F.concat("text", F.lit("\n  ")), "\n")).alias("line"))
    return lines.select("doc_id", C.blank_to_null("line").alias("line"))


@query("epoch_from_any", """
    SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS from_iso, CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS from_offset,
           CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS from_date,
           CAST(floor(epoch(ts)) AS BIGINT) AS from_number, CAST(NULL AS BIGINT) AS from_word FROM events""")
def epoch_from_any(t):
    ts = F.col("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select(
        "event_id", C.epoch(F.concat(iso, F.lit("Z"))).alias("from_iso"),
        C.epoch(F.concat(iso, F.lit("+02:00"))).alias("from_offset"),
        C.epoch(F.date_format(ts, "yyyy-MM-dd")).alias("from_date"),
        C.epoch(F.unix_timestamp(ts).cast("string")).alias("from_number"), C.epoch("event_type").alias("from_word"))


@query("media_ext", r"""
    SELECT page_id, CASE WHEN u IS NULL THEN NULL WHEN regexp_matches(lower(u), '\.jpe?g') THEN 'jpg' ELSE 'png' END
           AS ext FROM (SELECT page_id, CASE WHEN url LIKE '%#top' THEN NULL WHEN url LIKE 'https%'
           THEN url || '.JPEG' ELSE url END AS u FROM pages)""")
def media_ext(t):
    url = F.when(F.col("url").like("%#top"), None).when(F.col("url").startswith("https"),
                                                       F.concat("url", F.lit(".JPEG"))).otherwise(F.col("url"))
    return t.pages.select("page_id", C.media_ext(url).alias("ext"))


@query("link_template", """
    SELECT o_orderkey, 'https://cv.example.com/download/' || o_custkey || '/' || o_orderkey || '/{LANG}/{FORMAT}'
           AS link FROM orders""")
def link_template(t):
    return t.orders.select("o_orderkey", C.cv_link("https://cv.example.com/download/", "o_custkey", "o_orderkey")
                           .alias("link"))


@query("drop_incomplete", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE nullif(o_orderstatus, 'F') IS NOT NULL AND nullif(o_orderpriority, '2-HIGH') IS NOT NULL""")
def drop_incomplete(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
                           F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("p"))
    return C.drop_incomplete(rows).drop("p")


@query("filter_positive", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0")
def filter_positive(t):
    return t.lineitem.filter(F.col("l_discount") > 0).select("l_orderkey", "l_linenumber", "l_discount")


@query("filter_flags", "SELECT doc_id FROM labels WHERE NOT (toxic = 1) AND NOT (quality = 0)")
def filter_flags(t):
    return t.labels.filter(~(F.col("toxic") == 1) & ~(F.col("quality") == 0)).select("doc_id")


@query("filter_closed_period", """
    SELECT l_orderkey, l_linenumber, p AS period FROM (
      SELECT *, isoyear(l_shipdate) || lpad(CAST(week(l_shipdate) AS VARCHAR), 2, '0') AS p FROM lineitem)
    WHERE l_returnflag = 'A'
      AND CAST(substr(p, 1, 4) AS INTEGER) * 52 + CAST(substr(p, 5, 2) AS INTEGER) <= 2000 * 52 + 30 - 4""")
def filter_closed_period(t):
    tab = F.when(F.col("l_returnflag") == "A", "B").otherwise("N")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", iso_period("l_shipdate").alias("period"), tab.alias("tab"))
    return rows.filter(C.closed_period("period", "tab", 2000, 30)).drop("tab")


@query("filter_message_events", """
    SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND user_id <> 1
      AND starts_with(upper(event_type), 'C')""")
def filter_message_events(t):
    subtype = F.when(F.col("user_id") == 1, "bot_message")
    return t.events.filter(human_message(F.col("event_type"), F.upper("event_type"), subtype, ("click", "view"))).select(
        "event_id", "event_type")


@query("filter_merged_to_default", """
    SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL
      AND o_orderpriority = '1-URGENT'""")
def filter_merged_to_default(t):
    pull = F.struct(F.col("o_custkey").alias("merged_at"), F.col("o_orderpriority").alias("ref"))
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("type"), pull.alias("pull"))
    return rows.filter(merged_to_default(F.col("type"), F.col("pull.merged_at"), F.col("pull.ref"), F.lit("1-URGENT"), "F")).select(
        "o_orderkey")


@query("exclude_accounts", """
    SELECT c_custkey, c_mktsegment, CASE WHEN n_name IN ('NATION_7', 'NATION_15') THEN n_name END AS reply_to
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def exclude_accounts(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    found = rows.select("c_custkey", "c_mktsegment", F.col("n_name").alias("reply_to"))
    return exclude_accounts_of(found, ["BUILDING", "MACHINERY", "NATION_7", "NATION_15"], "c_mktsegment", "reply_to")


@query("prefix_flag", "SELECT doc_id, starts_with(text, 'The') AS flagged FROM documents")
def prefix_flag(t):
    return t.documents.select("doc_id", C.prefix_flag("text", "The").alias("flagged"))


@query("pick_locale", "SELECT doc_id, CASE WHEN lang = 'fr' THEN source ELSE '' END AS label FROM documents")
def pick_locale(t):
    return t.documents.select("doc_id", C.pick_locale(F.create_map("lang", "source"), "fr").alias("label"))


@query("nested_default_get", """
    SELECT event_id, coalesce(CASE WHEN event_type <> 'click' THEN CAST(props->>'$.k' AS BIGINT) END, -1) AS k,
           '' AS missing FROM events""")
def nested_default_get(t):
    body = F.from_json(F.when(F.col("event_type") != "click", F.col("props")), "k BIGINT, a STRUCT<b STRING>")
    return t.events.select("event_id", body.alias("p")).select(
        "event_id", F.coalesce("p.k", F.lit(-1).cast("bigint")).alias("k"),
        F.coalesce("p.a.b", F.lit("")).alias("missing"))


@query("split_dim_fact", """
    SELECT 'dim' AS part, c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
    UNION ALL SELECT 'fact', c_custkey, NULL, c_acctbal FROM customer""")
def split_dim_fact_query(t):
    dim, fact = split_dim_fact(t.customer, ["c_custkey", "c_name"], ["c_custkey", "c_acctbal"])
    return (dim.withColumn("part", F.lit("dim"))
            .unionByName(fact.withColumn("part", F.lit("fact")), allowMissingColumns=True))


@query("route_by_type", """
    SELECT 'created' AS target, event_id FROM events WHERE coalesce(nullif(event_type, 'view'), 'both')
           IN ('click', 'both')
    UNION ALL SELECT 'updated', event_id FROM events WHERE coalesce(nullif(event_type, 'view'), 'both')
           IN ('purchase', 'both')""")
def route_by_type(t):
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("type"))
    out = route(rows, "type", {"created": ["click", "both"], "updated": ["purchase", "both"]})
    return out["created"].select(F.lit("created").alias("target"), "event_id").union(
        out["updated"].select(F.lit("updated").alias("target"), "event_id"))


@query("years_since", """
    SELECT o_orderkey, CAST(CASE WHEN o_orderstatus IN ('F', 'P') THEN 0 ELSE 2024 - year(o_orderdate) END AS INTEGER)
           AS years FROM orders""")
def years_since(t):
    year = F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O",
                                                           F.year("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", C.years_since(year, 2024).alias("years"))


@query("distinguished_name_cn", "SELECT c_custkey, c_name AS cn, '' AS none FROM customer")
def distinguished_name_cn(t):
    name = F.concat(F.lit("CN="), "c_name", F.lit(",OU="), "c_mktsegment")
    return t.customer.select("c_custkey", C.common_name(name).alias("cn"), C.common_name("c_name").alias("none"))


@query("stable_guid", "SELECT c_custkey, sha1(c_name) AS guid FROM customer")
def stable_guid(t):
    return t.customer.select("c_custkey", C.stable_guid("c_name").alias("guid"))


@query("location_units", """
    SELECT doc_id, unnest(list_transform(list_filter(string_split(replace(text, 'e', '-'), ','), lambda x: contains(x, 'th')),
           lambda x: string_split(x, '-')[-1])) AS unit FROM documents""")
def location_units(t):
    dashed = F.regexp_replace("text", "e", "-")
    return t.documents.select("doc_id", F.explode(C.location_units(dashed, "th")).alias("unit"))


@query("strip_modifier", r"""
    SELECT event_id, event_type || regexp_replace('::skin-tone-' || (user_id % 7), '::skin-tone-.', '', 'g') || ':x'
           AS emoji FROM events""")
def strip_modifier(t):
    name = F.concat("event_type", F.lit("::skin-tone-"), (F.col("user_id") % 7).cast("string"), F.lit(":x"))
    return t.events.select("event_id", C.strip_modifier(name).alias("emoji"))


@query("clean_name", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g') AS name FROM pages")
def clean_name(t):
    return t.pages.select("page_id", C.clean_name("url").alias("name"))


def long_words():
    found = F.filter(F.split(F.regexp_replace("text", "\n", " "), " "), lambda w: F.length(w) >= 10)
    return F.transform(found, lambda w: F.struct(w.alias("text")))


@query("join_list_field", """
    SELECT doc_id, CASE WHEN len(l) > 0 THEN array_to_string(l, ';') END AS hashtags FROM (
      SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: length(w) >= 10) AS l
      FROM documents)""")
def join_list_field(t):
    return t.spread("documents").select("doc_id", C.join_field(long_words(), "text").alias("hashtags"))


@query("join_tag_list", """
    SELECT doc_id, array_to_string(list_transform(string_split(replace(text, chr(10), ' '), ' '),
           lambda w: CASE WHEN length(w) >= 10 THEN w ELSE '' END), ';') AS skills FROM documents""")
def join_tag_list(t):
    items = F.transform(F.split(F.regexp_replace("text", "\n", " "), " "), lambda w: F.struct(
        F.struct(F.when(F.length(w) >= 10, w).alias("no")).alias("tags")))
    return t.spread("documents").select("doc_id", C.join_tag_list(items, "tags").alias("skills"))


GRID = r"""
    SELECT doc_id, i, j, cells[j] AS cell FROM (
      SELECT doc_id, i, cells, unnest(range(1, len(cells) + 1)) AS j FROM (
        SELECT doc_id, i, string_split(lines[i], ' ') AS cells FROM (
          SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
            SELECT doc_id, string_split(chr(10) || '  ' || replace(text, chr(10), chr(10) || '  ') || chr(10), chr(10))
                   AS lines FROM documents))))"""


def framed_grid():
    """The document's lines as grid rows, framed by blank rows and columns."""
    framed = F.concat(F.lit("\n  "), F.regexp_replace("text", "\n", "\n  "), F.lit("\n"))
    return F.transform(F.split(framed, "\n"), lambda line: F.split(line, " "))


@query("grid_crop", f"""
    SELECT doc_id, CAST(min(i) - 1 AS INTEGER) AS "top", CAST(max(i) - 1 AS INTEGER) AS "bottom",
           CAST(min(j) - 1 AS INTEGER) AS "left", CAST(max(j) - 1 AS INTEGER) AS "right"
    FROM ({GRID}) WHERE cell <> '' GROUP BY doc_id""")
def grid_crop(t):
    return t.spread("documents").select("doc_id", bounds(framed_grid()).alias("b")).select("doc_id", "b.*") \
        .filter("top IS NOT NULL")


@query("grid_rows", f"""
    WITH g AS ({GRID}), used AS (SELECT * FROM g WHERE cell <> ''),
    box AS (SELECT doc_id, min(i) AS top, max(i) AS bottom, min(j) AS lft, max(j) AS rgt FROM used GROUP BY doc_id),
    heads AS (SELECT g.doc_id, j, cell AS header FROM g JOIN box ON g.doc_id = box.doc_id AND i = top
              WHERE j BETWEEN lft AND rgt),
    named AS (SELECT doc_id, header, max(j) AS j FROM heads GROUP BY doc_id, header),
    body AS (SELECT box.doc_id, unnest(range(top + 1, bottom + 1)) AS i, top FROM box)
    SELECT body.doc_id, CAST(body.i - body.top - 1 AS INTEGER) AS row_no, header,
           CASE WHEN regexp_full_match(cell, '\\s*') THEN NULL ELSE cell END AS value
    FROM body JOIN named ON body.doc_id = named.doc_id
    LEFT JOIN g ON g.doc_id = body.doc_id AND g.i = body.i AND g.j = named.j""")
def grid_rows(t):
    rows = grid_to_rows(t.spread("documents").select("doc_id", framed_grid().alias("g")), ["doc_id"], "g")
    return rows.select("doc_id", "row_no", F.explode("cells").alias("header", "value"))


def json_value(c):
    """A column as the JSON value it would be in a landed file."""
    return F.parse_json(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


@query("form_answers", r"""
    SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, parts[i] AS answer FROM (
      SELECT conv_id, turn, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
        SELECT conv_id, turn, CASE WHEN role = 'user' THEN ['[' || text] ELSE string_split(text, chr(10)) END AS parts
        FROM conversations))""")
def form_answers(t):
    """Turns as answers: a user's turn is one JSON text with a bracket in front, any other turn a JSON list of its lines."""
    response = F.when(F.col("role") == "user", json_value(F.concat(F.lit("["), "text"))).otherwise(json_value(F.split("text", "\n")))
    return t.conversations.select("conv_id", "turn", F.posexplode(answer_list(response)).alias("pos", "answer"))


@query("quiz_grade", """
    SELECT o_orderkey, o_orderpriority AS answer, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false
           END AS is_correct FROM orders""")
def quiz_grade_query(t):
    choices = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(ok).alias("isCorrect"))
                        for v, ok in (("1-URGENT", True), ("2-HIGH", False))])
    return t.orders.select("o_orderkey", F.col("o_orderpriority").alias("answer"),
                           quiz_grade(F.col("o_orderpriority"), choices).alias("is_correct"))
