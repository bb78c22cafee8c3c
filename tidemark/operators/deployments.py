"""Deployment counts, gap-filled daily series and frequency classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import lookup_join

# Class numbers and their labels.
FREQUENCY_LABELS = {1: "daily", 2: "weekly", 3: "monthly", 4: "yearly"}


def repo_label(name):
    """Short repository name: the part after the last slash."""
    return F.split_part(F.col(name) if isinstance(name, str) else name, F.lit("/"), F.lit(-1))


def deployments(df: DataFrame, id_col: str, ts_col: str, repo_col: str) -> DataFrame:
    """Distinct merged changes per repository and UTC day. `ts_col` is a timestamp."""
    return (df.groupBy(F.to_date(ts_col).alias("date"), F.col(repo_col).alias("repo"))
            .agg(F.count_distinct(id_col).alias("deployments")))


def gap_fill(daily: DataFrame, end: str, months: int = 3) -> DataFrame:
    """Every repository has a row for each day of the span; older days keep theirs.

    The days of one repository (as many as the calendar has, whatever the number of changes)
    are brought together and completed in place: the changes are read once, without a cross join.
    """
    end_day = F.to_date(F.lit(end))
    span = F.sequence(F.add_months(end_day, -months), end_day)
    series = daily.groupBy("repo").agg(F.collect_list(F.struct("date", "deployments")).alias("found"))
    known = F.array_compact(F.transform("found", lambda x: x["date"]))
    zeros = F.transform(F.array_except(span, known), lambda d: F.struct(
        d.alias("date"), F.lit(0).cast("long").alias("deployments")))
    return series.select("repo", F.inline(F.concat("found", zeros))).select("date", "repo", "deployments")


def frequency_class(filled: DataFrame) -> DataFrame:
    """Best class per repository from the median of active days per week and month.

    Weeks and months carry no year, so use spans of at most twelve months.
    """
    # Both calendars ride on one pass over the series: each day counts for its week and its month.
    units = F.array(F.struct(F.lit("week").alias("kind"), F.weekofyear("date").alias("no")),
                    F.struct(F.lit("month").alias("kind"), F.month("date").alias("no")))
    active = (filled.select("repo", (F.col("deployments") > 0).alias("on"), F.explode(units).alias("u"))
              .groupBy("repo", "u.kind", "u.no").agg(F.count_if("on").alias("n")))
    median = F.percentile_approx("n", 0.5).alias("m")
    week, month = F.col("kind") == "week", F.col("kind") == "month"
    rated = active.groupBy("repo", "kind").agg(median).filter(week | F.col("repo").isNotNull()).select(
        "repo", F.when(week & (F.col("m") >= 3), 1).when(week & (F.col("m") >= 1), 2)
        .when(month & (F.col("m") >= 1), 3).when(month, 4).alias("class"))
    return rated.groupBy("repo").agg(F.min("class").alias("class"))


def frequency_labels(spark) -> DataFrame:
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("frequency", T.StringType())])
    return spark.createDataFrame(list(FREQUENCY_LABELS.items()), schema)


def with_label(classes: DataFrame, labels: DataFrame) -> DataFrame:
    return classes.join(labels, classes["class"] == labels["id"]).select("repo", "frequency")


def deployment_frequency(filled: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    return with_label(frequency_class(filled), labels if labels is not None else frequency_labels(filled.sparkSession))


def row_access(df: DataFrame, bindings: DataFrame, group: str, repo_col: str = "repo") -> DataFrame:
    """Only the rows whose repository is bound to the viewer's group."""
    mine = bindings.filter(F.col("group") == group).select(F.col("repo").alias(repo_col)).distinct()
    return lookup_join(df, mine, [repo_col], "left_semi")
