"""Collects the queries and their SQL counterparts."""

from __future__ import annotations

import textwrap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import size_shuffles
from ..tables import files

QUERIES: dict = {}
ORACLES: dict = {}
GROUPS: dict = {}
SIZES: dict = {}
READ_BYTES = 128 * 1024 * 1024


def query(name: str, sql: str | None = None):
    def wrap(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            if sf_dir not in SIZES:
                SIZES[sf_dir] = files.size(spark, sf_dir)
            size_shuffles(spark, SIZES[sf_dir])
            return f(Tables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        GROUPS[name] = f.__module__.rsplit(".", 1)[-1]
        if sql:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return f
    return wrap


class Tables:
    """The input tables by name: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.schemas: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if name not in self.schemas:
            self.schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def spread(self, name: str) -> DataFrame:
        """A table for heavy work per row. A small file is read by one task, so its rows are dealt
        out first; tables large enough to be read by all cores are left alone.
        """
        cores = self.spark.sparkContext.defaultParallelism
        small = files.size(self.spark, f"{self.folder}/{name}.parquet") < cores * READ_BYTES
        return getattr(self, name).repartition(cores) if small else getattr(self, name)


def cents(c, digits: int = 2):
    """Sums of decimals held as doubles, rounded alike on both sides."""
    return F.round(c, digits)
