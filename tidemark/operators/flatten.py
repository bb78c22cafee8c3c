"""Nested records to flat columns and rows. Everything here is row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: list[str]):
    for field in schema.fields:
        here = path + [field.name]
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs become columns named by their path; lists stay as they are."""
    columns = []
    for path in _leaves(df.schema, []):
        reach = ".".join(f"`{p}`" for p in path)
        columns.append(F.col(reach).alias(sep.join(path)))
    return df.select(columns)


def explode_records(df: DataFrame, path: str, meta: list[str]) -> DataFrame:
    """One row per element of the record list, with parent columns; empty lists give no rows."""
    return df.select(*meta, F.inline(F.col(path)))


def explode_scalar(df: DataFrame, items: Column, out: str, meta: list[str]) -> DataFrame:
    return df.select(*meta, F.explode(items).alias(out))


def nested_elements(blocks: Column, keep) -> Column:
    """blocks → elements → elements as one array, filtered by `keep`."""
    second = F.flatten(F.transform(blocks, lambda b: F.coalesce(b["elements"], F.array())))
    third = F.flatten(F.transform(second, lambda e: F.coalesce(e["elements"], F.array())))
    return F.filter(third, keep)


def split_dim_fact(df: DataFrame, dim: list[str], fact: list[str]) -> tuple[DataFrame, DataFrame]:
    """A description table and a time-stamped measure table from one feed."""
    return df.select(*dim), df.select(*fact)


def route(df: DataFrame, type_col: str, outputs: dict[str, list[str]], default: str = "both") -> dict[str, DataFrame]:
    """Rows by type; a missing type counts as `default`. The type column is dropped."""
    kind = F.coalesce(F.col(type_col), F.lit(default))
    return {name: df.filter(kind.isin(kinds)).drop(type_col) for name, kinds in outputs.items()}
