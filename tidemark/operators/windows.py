"""Latest rows, ranks, period retention and merging."""

from __future__ import annotations

import math
from typing import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import pad_period
from .joins import lookup_join


def latest(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the newest `ts` of their key (ties kept).

    The maxima are combined map-side; the join back hashes on key *and* time, so the
    history of one hot key is spread over its times and can be split further at run time.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return lookup_join(df, newest, [*keys, ts], "left_semi")


def first_by(df: DataFrame, keys: list[str], order: list[Column | str], others: list[str]) -> DataFrame:
    """One row per key, the smallest in `order`; a plain aggregate with map-side combine."""
    pick = F.struct(*order)
    row = F.struct(*others)
    return (df.groupBy(*keys).agg(F.min_by(row, pick).alias("r"))
            .select(*keys, *[F.col(f"r.`{c}`").alias(c) for c in others]))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the smallest over all its other columns, so that a repeated run keeps the same one."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_r"))
    return picked.select([F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def dedupe_keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key. Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_periods(df: DataFrame, key: list[str], period: str, n: int) -> DataFrame:
    """Rows whose period has rank 1..n (with gaps) among the rows of their key, newest first.

    The rank of a period is one plus the number of rows in newer periods, so it comes from
    counts per (key, period); only these counts are windowed, never the rows.
    """
    w = Window.partitionBy(*key).orderBy(F.col(period).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*key, period).agg(F.count(F.lit(1)).alias("_c"))
    keep = (counts.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
            .filter(F.col("_before") < n).select(*key, period))
    return lookup_join(df, keep, [*key, period], "left_semi", nulls=True)


def newest_periods(df: DataFrame, key: str, period: str, n: int) -> DataFrame:
    """Per key the oldest of its n newest distinct periods, as `_since`. Only distinct periods are windowed."""
    w = Window.partitionBy(key).orderBy(F.col(period).desc())
    return (df.select(key, period).distinct().withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n)
            .groupBy(key).agg(F.min(period).alias("_since")))


def _count_last(batch: pa.RecordBatch, keys: list[str]) -> tuple[list, int]:
    """The key of a batch's last row, and how many rows have it."""
    last, same = [], None
    for k in keys:
        column = batch.column(k)
        value = column[-1]
        equal = pc.is_null(column) if not value.is_valid else pc.fill_null(pc.equal(column, value), False)
        if pa.types.is_floating(column.type) and value.is_valid and math.isnan(value.as_py()):
            equal = pc.fill_null(pc.is_nan(column), False)
        last.append(value)
        same = equal if same is None else pc.and_(same, equal)
    return last, pc.sum(same).as_py()


def rank_rows(df: DataFrame, keys: list[str], order: list[Column], out: str, ordered=()) -> DataFrame:
    """Number the rows of every group 1..n, whatever the size of the group, by a prefix sum over slices.

    All rows are range partitioned by group and order, so that a large group spans many slices and small ones share one. Only the
    last group of a slice can go on in later ones: each slice sends them one row with that group and its number of rows
    there, and the running sum over a group in its slice begins with those. Rows that are equal in `order` follow the order of all their columns;
    copies of a row are parted by the input partition they come from. `ordered` names the columns that `order` itself consists of.
    """
    conf = df.sparkSession.conf
    slices = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
    order = [*order, *[F.col(f"`{c}`") for c in df.columns if c not in keys and c not in ordered], F.col("_tie")]
    group = [F.col(f"`{k}`") for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema] + [
        T.StructField("_tie", T.IntegerType()), T.StructField("_slice", T.IntegerType()), T.StructField("_rows", T.LongType()),
        T.StructField("_sent", T.BooleanType())])

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, count, kind = TaskContext.get().partitionId(), None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, n = _count_last(batch, keys)
            before = last is not None and [repr(v.as_py()) for v in key] == [repr(v.as_py()) for v in last]
            count = n + (count if before and n == batch.num_rows else 0)
            last, kind = key, batch.schema
            size = batch.num_rows
            yield pa.record_batch([*batch.columns, pa.array([here] * size, pa.int32()), pa.array([1] * size, pa.int64()),
                                   pa.array([False] * size)], schema=whole(kind))
        later = slices - here - 1
        if last is not None and later > 0:
            held = dict(zip(keys, last))
            columns = [pa.array([held[f.name].as_py()] * later, f.type) if f.name in held else pa.nulls(later, f.type) for f in kind]
            yield pa.record_batch([*columns, pa.array(range(here + 1, slices), pa.int32()), pa.array([count] * later, pa.int64()),
                                   pa.array([True] * later)], schema=whole(kind))

    def whole(kind: pa.Schema) -> pa.Schema:
        return pa.schema([pa.field(f.name, f.type) for f in kind] + [
            pa.field("_slice", pa.int32()), pa.field("_rows", pa.int64()), pa.field("_sent", pa.bool_())])

    dealt = df.withColumn("_tie", F.spark_partition_id()).repartitionByRange(slices, *group, *order).sortWithinPartitions(*group)
    running = Window.partitionBy("_slice", *group).orderBy(F.desc("_sent"), *order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.mapInArrow(sliced, schema).withColumn(out, F.sum("_rows").over(running)).filter("NOT _sent").select(
        *[F.col(f"`{c}`") for c in df.columns], out)


def weight_rank(df: DataFrame, key: str, value: str, ties: list[str], out: str = "weigth") -> DataFrame:
    """1 for the largest value of a key, 2 for the next, …; ties are ordered by `ties`."""
    return rank_rows(df, [key], [F.col(value).desc(), *[F.col(c) for c in ties]], out, [value, *ties])


def keep_latest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the n newest distinct periods; padded and unpadded week codes mean the same week."""
    code = pad_period(period)
    newest = df.select(code.alias("_p")).distinct().orderBy(F.col("_p").desc()).limit(n)
    return df.join(newest, code == newest["_p"], "left_semi")


def merge_new_with_old(new: DataFrame, old: DataFrame, ignore: list[str]) -> DataFrame:
    """New and old rows, equal rows (apart from `ignore`) once; the new one wins."""
    keys = [c for c in new.columns if c not in ignore]
    both = new.withColumn("_old", F.lit(0)).unionByName(old.select(*new.columns).withColumn("_old", F.lit(1)))
    if len(ignore) == 1 and isinstance(new.schema[ignore[0]].dataType, T.NumericType) and new.schema[ignore[0]].dataType == old.schema[ignore[0]].dataType:
        # Numbers are combined by hashing; the minimum of a struct would sort all rows twice. A null comes before any number.
        value = F.col(f"`{ignore[0]}`")
        least = lambda side: F.when(~F.max((F.col("_old") == side) & value.isNull()), F.min(F.when(F.col("_old") == side, value)))
        merged = both.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.when(F.min("_old") == 0, least(0)).otherwise(least(1)).alias("_m"))
        return merged.select([F.col("_m").alias(c) if c in ignore else F.col(f"`{c}`") for c in new.columns])
    order = F.struct("_old", *ignore)
    merged = both.groupBy(*keys).agg(F.min(order).alias("_m"))
    return merged.select([F.col(f"_m.`{c}`").alias(c) if c in ignore else F.col(f"`{c}`") for c in new.columns])
