"""Results as JSON or CSV lines, built by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export(df: DataFrame, fmt: str = "json") -> DataFrame:
    """One text column `value` with one record per row; JSON keeps null fields, CSV has a line of column names."""
    if fmt == "json":
        return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    if fmt == "csv":
        names = F.to_csv(F.struct(*[F.lit(c).alias(c) for c in df.columns]))
        return df.sparkSession.range(1).select(names.alias("value")).union(df.select(F.to_csv(F.struct("*"))))
    raise ValueError(f"unknown format {fmt}")


def write_export(df: DataFrame, path: str, fmt: str = "json") -> None:
    if fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    elif fmt == "csv":
        df.write.mode("overwrite").option("header", "true").csv(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def filters_from_text(parts: list[str]) -> dict[str, str]:
    """`field:value` request filters; the value keeps further colons."""
    return dict(part.split(":", 1) for part in parts)
