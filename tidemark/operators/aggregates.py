"""Grouped results that combine map-side before any shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_list(df: DataFrame, keys: list[str], value: str, out: str, sep: str = ";") -> DataFrame:
    """All values of a group, sorted and joined; null counts as ''.

    One output value holds the whole list, so feed it rows that are distinct per
    (key, value) where the domain of `value` is bounded, as the reports do.
    """
    text = F.coalesce(F.col(value).cast("string"), F.lit(""))
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(text)), sep).alias(out))


def joined_set(df: DataFrame, keys: list[str], value: str, out: str, sep: str = ";") -> DataFrame:
    """The distinct values of a group, sorted and joined."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(out))


def json_set(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The distinct values of a group as a JSON array text."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return rows.groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_set(value))).alias(out))


def latest_value(df: DataFrame, keys: list[str], when: str, value: str) -> DataFrame:
    """Per key the newest `when` and, among its rows, the greatest `value`."""
    best = F.max(F.struct(when, value)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, F.col(f"_b.{value}").alias(value), F.col(f"_b.{when}").alias(when))


def ratio(part: Column, whole: Column, scale: float = 1) -> Column:
    return F.lit(scale) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def project_rollup(df: DataFrame, now) -> DataFrame:
    """Hours per (customer, work order, period); people per (customer, work order) over all periods.

    Each is one aggregate over the rows: few rows share person and period, so an aggregate by these first would only shuffle them twice.
    """
    grain = ["customer", "work_order_description"]
    hours = df.groupBy(*grain, "reg_period").agg(F.sum(F.col("used_hrs").cast("double")).alias("hours"))
    people = df.groupBy(*grain).agg(F.count_distinct("alias").alias("employees"))
    return (hours.join(people, grain)
            .select("customer", "employees", "hours", "reg_period", F.lit(now).alias("timestamp"),
                    F.col("work_order_description").alias("work_order")))


def snapshot_count(df: DataFrame, now: int, out: str = "number_of_employees") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out)).select(F.lit(now).cast("long").alias("time"), out)


def degree_class(degree) -> Column:
    """3 doctorate, 2 master, 1 bachelor, 0 anything else, judged by words in the degree text."""
    text = F.lower(degree)
    has = lambda words: reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return (F.when(text.isNull(), 0).when(has(DOCTORATE), 3).when(has(MASTER), 2)
            .when(has(BACHELOR) | text.endswith("bachelor"), 1).otherwise(0))


# The words that decide the class of a degree text.
DOCTORATE = ["phd ", "doktor ", "doktorgrad", "profesjonsstudiet"]
MASTER = ["master", "sivil", "siv.", "cand", "m."]
BACHELOR = ["bachelor ", "bachelor,", "(bachelor)", "bachelorgrad", "ingeniør", "b.", "3-år"]
