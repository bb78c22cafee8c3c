"""Reading only what is new, per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join

# Fixed value: where the first run of a source starts.
FIRST_MARK = "2010-01-01 00:00:00"


def incremental(df: DataFrame, marks: DataFrame, source_col: str, ts_col: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Rows at or after their source's mark and before `now`, and the marks of the next run.

    `marks` has (source, mark). Sources without a mark start at FIRST_MARK; sources that had
    a mark but no rows advance too.
    """
    known = marks.groupBy(F.col("source").alias(source_col)).agg(F.max("mark").alias("_mark"))
    start = F.coalesce("_mark", F.lit(FIRST_MARK).cast(df.schema[ts_col].dataType))
    rows = (lookup_join(df, known, [source_col], "left")
            .filter((F.col(ts_col) >= start) & (F.col(ts_col) < now)).select(*df.columns))
    sources = df.select(F.col(source_col).alias("source")).union(marks.select("source")).distinct()
    return rows, sources.select("source", now.alias("mark"))


def newest_group(df: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """The single id of the newest record: a one-row frame found by an aggregate, without a sort."""
    return df.agg(F.max_by(id_col, F.struct(*order)).alias(id_col))
