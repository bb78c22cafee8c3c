"""Joins that keep a hot key from landing in one task.

No broadcast hints here: Catalyst broadcasts a side only below its size limit,
and adaptive execution checks that limit again with the real shuffle sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def lookup_join(df: DataFrame, side: DataFrame, keys: list[str], how: str = "inner", nulls: bool = False) -> DataFrame:
    """Join rows that may hold hot keys with a side of few rows per key; also `left`, `left_semi`, `left_anti`.

    A side that was aggregated (or joined before) by the key is partitioned by it already, and
    adaptive execution splits a hot key only where both inputs come straight from a shuffle. Null-safe equality gives
    both sides a shuffle of their own. Null keys match nothing unless `nulls` is set.
    Below the broadcast limit there is no shuffle at all.
    """
    extra = [c for c in side.columns if c not in keys]
    if not nulls:
        side = side.na.drop("any", subset=keys)
        if how in ("inner", "left_semi"):
            df = df.na.drop("any", subset=keys)  # null-safe equality hides from Catalyst that they match nothing
    side = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_side_{k}`")) for k in keys])
    joined = df.join(side, match, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*[F.col(f"`{c}`") for c in df.columns + extra])


#: Rows that stand for "no partner" in a left join; left rows without one are dealt to them.
EMPTY_ROWS = 64


def left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left outer join whose *right* side may hold hot keys. Needs keys named alike; the left side is read once.

    Adaptive execution can split a skewed right side of an inner join but not of a
    left outer one. So left rows are first marked by the (distinct, map-side combined) right keys, and those without a partner
    join one of EMPTY_ROWS rows of nulls that are added to the right side: one inner join gives all rows.
    """
    extra = [c for c in right.columns if c not in keys]
    held = right.select(*keys).distinct().withColumn("_held", F.lit(True))
    partner = F.col("_held").isNotNull()
    probe = lookup_join(left, held, keys, "left").select(
        *[F.col(f"`{c}`").alias(f"_own_{i}") for i, c in enumerate(left.columns)], *[F.when(partner, F.col(f"`{k}`")).alias(f"_left_{k}") for k in keys],
        F.when(partner, F.lit(-1)).otherwise(F.spark_partition_id() % EMPTY_ROWS).alias("_left_place"))
    kind = {f.name: f.dataType for f in right.schema}
    empty = left.sparkSession.range(EMPTY_ROWS).select(
        *[F.lit(None).cast(kind[k]).alias(f"_right_{k}") for k in keys], *[F.lit(None).cast(kind[c]).alias(f"_extra_{i}") for i, c in enumerate(extra)],
        F.col("id").cast("int").alias("_right_place"))
    side = right.na.drop("any", subset=keys).select(
        *[F.col(f"`{k}`").alias(f"_right_{k}") for k in keys], *[F.col(f"`{c}`").alias(f"_extra_{i}") for i, c in enumerate(extra)], F.lit(-1).alias("_right_place")).union(empty)
    match = reduce(lambda a, b: a & b, [F.col(f"`_left_{c}`").eqNullSafe(F.col(f"`_right_{c}`")) for c in [*keys, "place"]])
    named = [(f"_own_{i}", c) for i, c in enumerate(left.columns)] + [(f"_extra_{i}", c) for i, c in enumerate(extra)]
    return probe.join(side, match).select(*[F.col(inner).alias(c) for inner, c in named])


def new_rows(df: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key is not in `existing`; null keys compare equal. No target, no filter."""
    if existing is None:
        return df
    known = existing.select(*keys).distinct()
    return df.join(known, _null_safe(df, known, keys), "left_anti")


def resolve_person(df: DataFrame, directory: DataFrame, by: str, on: str | None = None) -> DataFrame:
    """Add `guid` by looking a person up by guid, email, alias or full name; unknown people are dropped."""
    on = on or by
    if on not in df.columns:
        raise ValueError(f"id column {on} is missing")
    if by == "guid":
        return df.withColumn("guid", F.col(on)).filter(F.col("guid") != "")
    column = "displayName" if by == "full_name" else by
    people = (directory.filter(F.col(column).isNotNull() & (F.col("guid") != ""))
              .groupBy(F.col(column).alias(on)).agg(F.min("guid").alias("guid")))
    return lookup_join(df.drop("guid") if on != "guid" else df, people, [on])


def lookup_manager(df: DataFrame, directory: DataFrame, by: str, on: str | None = None) -> DataFrame:
    """Add `manager` of the person, '' when the person is unknown."""
    on = on or by
    column = "displayName" if by == "full_name" else by
    people = (directory.filter(F.col(column).isNotNull())
              .groupBy(F.col(column).alias(on)).agg(F.min_by("manager", "guid").alias("manager")))
    return lookup_join(df, people, [on], "left").withColumn("manager", F.coalesce("manager", F.lit("")))


def map_dimension(df: DataFrame, mapping: DataFrame, keys: dict[str, str], replace: dict[str, str]) -> DataFrame:
    """Replace columns through a composite-key mapping; unmapped rows keep their values.

    `keys`: df column -> mapping key column; `replace`: df column -> mapping value column.
    The mapping is deduplicated as rows, so one key with two targets gives two rows.
    """
    used = sorted(set(keys.values()) | set(replace.values()))
    side = mapping.select([F.col(f"`{c}`").alias(f"map:{c}") for c in used]).distinct()
    condition = reduce(lambda a, b: a & b, [df[k] == side[f"`map:{v}`"] for k, v in keys.items()])
    hit = F.col(f"`map:{next(iter(keys.values()))}`").isNotNull()
    return df.join(side, condition, "left").select([
        F.when(hit, F.col(f"`map:{replace[c]}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in replace
        else F.col(f"`{c}`") for c in df.columns
    ])


def self_manager(people: DataFrame, own: str, manager_of: str, email: str, order: str) -> DataFrame:
    """Add manager name and email found in the same table; the last row with that name wins."""
    bosses = (people.filter(F.col(own).isNotNull()).groupBy(F.col(own).alias(manager_of))
              .agg(F.max_by(F.col(email), F.col(order)).alias("manager_email")))
    return lookup_join(people, bosses.select(manager_of, F.col(manager_of).alias("manager"), "manager_email"),
                       [manager_of], "left")


def unmatched_full(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer join restricted to rows whose right key is null or ''.

    Written as its three disjoint parts, so that neither side has to be kept whole per key.
    """
    lonely_left = lookup_join(left, right.select(F.col(right_key).alias(left_key)).distinct(), [left_key], "left_anti")
    odd = right.filter(F.col(right_key).isNull() | (F.col(right_key) == ""))
    lonely_right = lookup_join(odd, left.select(F.col(left_key).alias(right_key)).distinct(), [right_key], "left_anti")
    blank = left.join(odd, left[left_key] == odd[right_key], "inner")
    return (blank.unionByName(lonely_left, allowMissingColumns=True)
            .unionByName(lonely_right, allowMissingColumns=True))
