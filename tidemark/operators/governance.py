"""Report registry rules as jobs over a registry table.

Registry columns: name, queryString, tables ARRAY<STRING>, dataProtection, created, lastUsed, lastCacheUpdate.
Catalogue columns: database, table.
"""

from __future__ import annotations

import json

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import lookup_join

IGNORED = r"(?s)'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/"
IDENTIFIER = r"([a-z_][a-z0-9_]*(?:\.[a-z_][a-z0-9_]*)*)"
NAMED = r"(\w+)\s+as\s*\("


def relations(spark: SparkSession, sql: str) -> list[list[str]] | None:
    """Name parts of the tables that a statement reads, by Spark's own parser; None if that cannot parse it.

    Names bound by WITH are resolved by their scope, so that a table of the same name outside of it, or inside its own definition, still
    counts. Columns, aliases, texts and comments are not tables, whatever they are called.
    """
    state = spark._jsparkSession.sessionState()
    try:
        plan = spark._jvm.org.apache.spark.sql.catalyst.analysis.CTESubstitution.apply(state.sqlParser().parsePlan(sql))
    except ParseException:
        return None
    found, todo = [], [json.loads(plan.toJSON())]
    while todo:
        part = todo.pop()
        if isinstance(part, dict):
            if str(part.get("class", "")).endswith(".UnresolvedRelation"):
                found.append(part["multipartIdentifier"][1:-1].split(", "))
            todo.extend(part.values())
        elif isinstance(part, list):
            todo.extend(part)
    return found


def referenced(registry: DataFrame) -> DataFrame:
    """(name, ref, table, given): the tables that each statement reads, in lower case; `given` is the database if it is named.

    Every different statement is parsed once, by the driver. Of a statement that Spark cannot parse every identifier counts (texts in quotes,
    comments and names bound by WITH do not): which of them are tables is for the catalogue to say, so no table is missed.
    """
    spark = registry.sparkSession
    setting = "spark.sql.ansi.doubleQuotedIdentifiers"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        read = [(r[0], relations(spark, r[0])) for r in registry.select("queryString").dropna().distinct().toLocalIterator()]
    finally:
        spark.conf.set(setting, before)
    rows = [(sql, ".".join(p).lower(), p[-1].lower(), p[-2].lower() if len(p) > 1 else None) for sql, found in read for p in found or []]
    parsed = spark.createDataFrame(rows, "sql STRING, ref STRING, table STRING, given STRING").distinct()
    named = lookup_join(registry.select("name", F.col("queryString").alias("sql")), parsed, ["sql"]).select("name", "ref", "table", "given")
    odd = [(sql,) for sql, found in read if found is None]
    if not odd:
        return named
    strange = registry.join(spark.createDataFrame(odd, "queryString STRING"), "queryString", "left_semi")
    return named.unionByName(_identifiers(strange))


def _identifiers(registry: DataFrame) -> DataFrame:
    """(name, ref, table, given): every identifier of a statement, whatever clause it stands in, without names bound by WITH."""
    sql = F.regexp_replace(F.regexp_replace(F.lower("queryString"), IGNORED, " "), '["`]', "")
    names = F.array_distinct(F.array_except(F.regexp_extract_all(sql, F.lit(IDENTIFIER), F.lit(1)),
                                            F.regexp_extract_all(sql, F.lit(NAMED), F.lit(1))))
    return registry.select("name", F.explode(names).alias("ref")) \
        .select("name", "ref", F.split_part("ref", F.lit("."), F.lit(-1)).alias("table"),
                F.when(F.col("ref").contains("."), F.split_part("ref", F.lit("."), F.lit(1))).alias("given"))


def lineage(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, database, table): an unqualified name belongs to the database that holds it."""
    places = catalog.select("database", F.lower("table").alias("table")).distinct()
    return (referenced(registry).join(places, "table")
            .filter(F.col("given").isNull() | (F.col("given") == F.lower("database")))
            .select("name", "database", "table").distinct())


def protection(registry: DataFrame, lines: DataFrame, floor: int = 3) -> DataFrame:
    """Level of every report: the highest among its tables, at least `floor`, also where no table is known.

    Only levels 1-3 are allowed; a table of any other level, or of a database without one, makes the report not allowed.
    """
    level = F.regexp_extract("database", r"level_(\d)", 1).try_cast("int")
    known = lines.groupBy("name").agg(F.max(level).alias("_max"), F.bool_and(F.coalesce(level.between(1, 3), F.lit(False))).alias("_ok"))
    return (lookup_join(registry.select("name").distinct(), known, ["name"], "left")
            .select("name", F.greatest(F.lit(floor), F.coalesce("_max", F.lit(floor))).alias("level"),
                    F.coalesce("_ok", F.lit(True)).alias("allowed")))


def is_select(sql):
    return F.coalesce(F.col(sql).rlike(r"(?is)^\s*(select|with)\b")
                      & ~F.col(sql).rlike(r"(?is)^\s*with\b.*\)\s*(insert|update|delete|merge)\b"), F.lit(False))


def non_select(registry: DataFrame) -> DataFrame:
    """Reports that do anything but read."""
    return registry.filter(~is_select("queryString"))


def dependents(registry: DataFrame, changed: DataFrame) -> DataFrame:
    """Names of the reports that read any changed table (`changed` has a column `table`)."""
    uses = registry.select("name", F.explode("tables").alias("table"))
    return lookup_join(uses, changed.select("table").distinct(), ["table"], "left_semi").select("name").distinct()


def upsert(registry: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """Add reports with new names; with `replace`, incoming reports win over stored ones.

    Of incoming reports with one name the last created counts (equal: the last in column order).
    """
    rest = [c for c in registry.columns if c != "name"]
    new = (new.groupBy("name").agg(F.max_by(F.struct(*rest), F.struct("created", *rest)).alias("_r"))
           .select("name", *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*registry.columns))
    if replace:
        kept = registry.join(new.select("name").distinct(), "name", "left_anti").select(*registry.columns)
        return kept.unionByName(new)
    fresh = new.join(registry.select("name").distinct(), "name", "left_anti").select(*registry.columns)
    return registry.unionByName(fresh)


def remove(registry: DataFrame, names: DataFrame) -> DataFrame:
    return registry.join(names.select("name").distinct(), "name", "left_anti").select(*registry.columns)


def touch(registry: DataFrame, names: DataFrame, now: str, column: str = "lastCacheUpdate") -> DataFrame:
    """Set a time stamp on the named reports; an unknown name is an error."""
    wanted = names.select("name", F.lit(True).alias("_hit")).distinct()
    unknown = wanted.join(registry.select("name").distinct(), "name", "left_anti")
    first = unknown.head()
    if first is not None:
        raise KeyError(f"no report named {first['name']}")
    return (registry.join(wanted, "name", "left")
            .withColumn(column, F.when(F.col("_hit"), F.lit(now)).otherwise(F.col(column)))
            .select(*registry.columns))
