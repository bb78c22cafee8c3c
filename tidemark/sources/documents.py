"""XML and HTML documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCRIPT = r"(?is)<script[^>]*>(.*?)</script>"


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """XML files, one row per `row_tag` element. The schema is given, never inferred."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


FORECAST = """location STRUCT<name STRING>, forecast STRUCT<tabular STRUCT<time ARRAY<STRUCT<
    _from STRING, _to STRING, precipitation STRUCT<_value DOUBLE>, windSpeed STRUCT<_mps DOUBLE>,
    temperature STRUCT<_value INT>, pressure STRUCT<_value DOUBLE>>>>>"""


def _step_pattern() -> str:
    """A forecast step whose readings are plain numbers, in the provider's order; other attributes and empty elements may stand between.

    Everything repeats possessively, so that a match takes no stack. Names compare without case, as Spark's XML reader does.
    """
    plain = r"[\p{L}\p{N} :.,/%()+_-]*+"

    def others(tag: int, known: str) -> str:
        # an attribute that comes twice makes the document malformed
        return rf'(?:\s++(?!(?i:{known})=)(?<a{tag}>[A-Za-z]\w*+)="{plain}"(?![^>]*\s\k<a{tag}>=))*+'

    def own(tag: int, name: str, attribute: str, value: str) -> str:
        return rf'<{name}{others(2 * tag, attribute)}\s++{attribute}="(?<v{tag}>{value})"{others(2 * tag + 1, attribute)}\s*+/>'

    def gap(tag: int) -> str:
        return rf"\s*+(?:<(?!(?i:time|precipitation|windSpeed|temperature|pressure)[\s/>])[A-Za-z]\w*+{others(tag, '_')}\s*+/>\s*+)*+"

    time, real, whole = r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", r"-?\d{1,15}+(?:\.\d{1,15}+)?+(?:E-?\d\d?+)?+", r"-?\d{1,9}+"
    head = rf'<time{others(90, "from|to")}\s++from="(?<v0>{time})"{others(91, "from|to")}\s++to="(?<v1>{time})"{others(92, "from|to")}\s*+>'
    readings = (("precipitation", "value", real), ("windSpeed", "mps", real), ("temperature", "value", whole), ("pressure", "value", real))
    return rf"\G{head}{gap(93)}" + "".join(own(i, *r) + gap(92 + i) for i, r in enumerate(readings, 2)) + r"</time>\s*+"


STEP = _step_pattern()


def forecast_rows(parsed: DataFrame, location, first: int = 24) -> DataFrame:
    """Weather records of the first `first` steps of every parsed forecast document."""
    steps = parsed.select(location.alias("location"), F.col("location.name").alias("location_name"),
                          F.explode(F.slice("forecast.tabular.time", 1, first)).alias("t"))
    seconds = lambda c: F.unix_timestamp(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")
    return steps.select(
        "location", "location_name", seconds("t._from").alias("time_from"), seconds("t._to").alias("time_to"),
        F.col("t.precipitation._value").alias("precipitation"), F.col("t.windSpeed._mps").alias("wind_speed"),
        F.col("t.temperature._value").alias("temperature"), F.col("t.pressure._value").alias("air_pressure"))


def forecast_texts(df: DataFrame, xml, location, first: int = 24) -> DataFrame:
    """The rows of `forecast_rows` from forecast documents held as texts.

    The XML reader builds rows for every element with attributes, which is most of the time. So it reads each document with its run
    of steps put as one mark, and the steps are matched as they repeat. A document with anything in its run but plain
    steps (`STEP`), or whose mark does not come back as the forecast's only step, is read as a whole.
    """
    mark = F.lit('<time from="@"/>')
    texts = df.select(location.alias("location"), xml.alias("_xml")).withColumns({
        "_head": F.substring_index("_xml", "<time ", 1), "_tail": F.substring_index("_xml", "</time>", -1)})
    run = F.substring("_xml", F.length("_head") + 1, F.length("_xml") - F.length("_head") - F.length("_tail"))
    values = ",".join(f"${{v{i}}}" for i in range(6))
    # The run ends with a step's end, so that whatever does not match leaves a tag.
    cut = texts.withColumn("_run", F.regexp_replace(run, F.lit(STEP), F.lit(values + ";")))
    plain = (F.col("_run") != "") & ~F.contains("_run", F.lit("<"))
    framed = cut.withColumn("_frame", F.when(plain, F.from_xml(F.concat("_head", mark, "_tail"), FORECAST)))
    times = F.col("_frame.forecast.tabular.time")
    framed = framed.withColumn("_plain", F.coalesce((F.size(times) == 1) & (F.get(times, F.lit(0))["_from"] == "@"), F.lit(False)))
    read = framed.withColumn("_frame", F.when(F.col("_plain"), F.col("_frame")).otherwise(F.from_xml("_xml", FORECAST))) \
        .withColumn("location_name", F.col("_frame.location.name"))
    kind = read.schema["_frame"].dataType["forecast"].dataType["tabular"].dataType["time"].dataType.elementType
    runs = F.split("_run", ";")
    matched = F.transform(F.slice(runs, 1, F.least(F.lit(first), F.size(runs) - 1)),
                          lambda s: F.struct(s.alias("values"), F.lit(None).cast(kind).alias("t")))
    parsed = F.transform(F.slice("_frame.forecast.tabular.time", 1, first), lambda t: F.struct(F.lit(None).cast("string").alias("values"), t.alias("t")))
    steps = read.select("location", "location_name", F.explode(F.when(F.col("_plain"), matched).otherwise(parsed)).alias("_s")) \
        .select("location", "location_name", F.split("_s.values", ",").alias("v"), F.col("_s.t").alias("t"))
    value = lambda i, c, kind: F.when(F.col("v").isNotNull(), F.get("v", F.lit(i)).cast(kind)).otherwise(F.col(c))

    def seconds(i, c):
        text = F.coalesce(F.get("v", F.lit(i)), F.col(c))
        exact = F.when(F.col("v").isNotNull(), F.unix_seconds(text.try_cast("timestamp")))
        return F.coalesce(exact, F.unix_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss"))

    return steps.select(
        "location", "location_name", seconds(0, "t._from").alias("time_from"), seconds(1, "t._to").alias("time_to"),
        value(2, "t.precipitation._value", "double").alias("precipitation"), value(3, "t.windSpeed._mps", "double").alias("wind_speed"),
        value(4, "t.temperature._value", "int").alias("temperature"), value(5, "t.pressure._value", "double").alias("air_pressure"))


def scripts(html) -> Column:
    """Bodies of all script blocks."""
    return F.regexp_extract_all(F.col(html) if isinstance(html, str) else html, F.lit(SCRIPT), F.lit(1))


def html_json(df: DataFrame, html_col: str, marker: str, schema, meta: list[str]) -> DataFrame:
    """The JSON objects of script blocks that start with `marker`: first `{` to last `}`, parsed as `json`."""
    bodies = F.filter(scripts(html_col), lambda s: s.startswith(marker))
    cut = F.transform(bodies, lambda s: F.regexp_extract(s, r"(?s)(\{.*\})", 1))
    return df.select(*meta, F.explode(cut).alias("_j")).select(*meta, F.from_json("_j", schema).alias("json"))


BLOG_REFERENCES = """references STRUCT<
  User MAP<STRING, STRUCT<name STRING, username STRING>>,
  Post MAP<STRING, STRUCT<id STRING, creatorId STRING, title STRING, createdAt DOUBLE, updatedAt DOUBLE,
    firstPublishedAt DOUBLE, latestPublishedAt DOUBLE, detectedLanguage STRING, uniqueSlug STRING,
    virtuals STRUCT<wordCount BIGINT, readingTime DOUBLE, totalClapCount BIGINT, recommends BIGINT,
      responsesCreatedCount BIGINT>>>>"""


def blog_posts(df: DataFrame, html_col: str, marker: str, site: str) -> DataFrame:
    """Post records of blog archive pages, with author data from the page's own user map."""
    found = html_json(df, html_col, marker, BLOG_REFERENCES, [])
    post = found.select(F.col("json.references.User").alias("u"),
                        F.explode(F.map_values("json.references.Post")).alias("p"))
    author = lambda field: F.coalesce(F.try_element_at("u", F.col("p.creatorId"))[field], F.lit(""))
    seconds = lambda c: (F.col(c) / 1000).cast("long")
    return post.select(
        F.col("p.id").alias("medium_id"), author("name").alias("author_name"),
        author("username").alias("author_username"), F.col("p.title").alias("title"),
        seconds("p.createdAt").alias("created_at"), seconds("p.updatedAt").alias("updated_at"),
        seconds("p.firstPublishedAt").alias("first_published_at"),
        seconds("p.latestPublishedAt").alias("latest_published_at"),
        F.col("p.virtuals.wordCount").alias("word_count"), F.col("p.virtuals.readingTime").alias("reading_time"),
        F.col("p.virtuals.totalClapCount").alias("total_claps"),
        F.col("p.virtuals.recommends").alias("total_unique_claps"),
        F.col("p.detectedLanguage").alias("language"),
        F.concat(F.lit(site.rstrip("/") + "/"), "p.uniqueSlug").alias("url"),
        F.col("p.virtuals.responsesCreatedCount").alias("comments_count"))


def html_links(html, pattern: str, own_url) -> Column:
    """Distinct link targets that start with `pattern`; the page's own address when there is none."""
    html = F.col(html) if isinstance(html, str) else html
    own_url = F.col(own_url) if isinstance(own_url, str) else own_url
    targets = F.regexp_extract_all(html, F.lit(r"""(?i)href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    wanted = F.array_distinct(F.filter(targets, lambda x: x.rlike("^(?:" + pattern + ")")))
    return F.when(F.size(wanted) > 0, wanted).otherwise(F.array(own_url))
