"""Declaring a source job: envelopes in, a dict of tables out, written by the store's rules."""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import resolve_person
from ..tables import files
from ..tables.store import TableStore


@dataclass
class Context:
    """What a transform may look at besides its envelopes."""

    spark: SparkSession
    now: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    store: TableStore | None = None
    options: dict = field(default_factory=dict)
    scratch: list[str] = field(default_factory=list)  # folders to drop when the run is over
    database: str | None = None  # level database that shows what was written

    def existing(self, name: str) -> DataFrame | None:
        return self.store.read_or_none(name) if self.store else None


class Job:
    def __init__(self, f, payload, partitions, overwrite, purge_versions, historical, person_tables, parse_once, stage):
        functools.update_wrapper(self, f)
        self.f = f
        self.payload = payload
        self.partitions = partitions
        self.overwrite = overwrite
        self.purge_versions = purge_versions
        self.historical = historical
        self.person_tables = person_tables
        self.parse_once = parse_once
        self.stage = stage

    def tables(self, envelopes: DataFrame, context: Context, directory: DataFrame | None = None) -> dict:
        """Output tables as lazy DataFrames, people resolved."""
        return self._tables(self.stage(envelopes), context, directory)

    def _tables(self, staged: DataFrame, context: Context, directory: DataFrame | None) -> dict:
        tables = self.f(staged, context)
        if not isinstance(tables, dict):
            raise TypeError("a transform must return a dict of DataFrames")
        for name, by in self.person_tables.items():
            if directory is None:
                raise ValueError("this job needs the person directory")
            tables[name] = resolve_person(tables[name], directory, by)
        return tables

    def run(self, envelopes: DataFrame, context: Context, directory: DataFrame | None = None,
            batch: str | None = None) -> list[str]:
        """Write all output tables; returns the names that changed. A named `batch` may be repeated.

        Jobs with several outputs store the parsed envelopes, or what `stage` makes of them, as Parquet first:
        the JSON is read once, and each output then scans only its own columns.
        """
        spark, store = context.spark, context.store
        parsed = f"{store.root}/staged/input-{uuid.uuid4().hex}"
        staged = self.stage(envelopes)
        if self.parse_once:
            staged.write.parquet(parsed)
            staged = spark.read.schema(staged.schema).parquet(parsed)
        try:
            names = store.write_all(self._tables(staged, context, directory), self.partitions,
                                    self.overwrite, self.purge_versions, self.historical, batch)
            for name in names if context.database else []:
                store.register(name, context.database)
            return names
        finally:
            for path in [parsed, *context.scratch]:
                files.remove(spark, path)
            context.scratch.clear()


def job(payload: str, partitions: dict | None = None, overwrite: bool = False, purge_versions: bool = False,
        historical=(), person_tables: dict | None = None, parse_once: bool = False, stage=lambda envelopes: envelopes):
    """Decorator for `f(envelopes, context) -> dict[str, DataFrame]`; `payload` is the schema of `data`.

    `stage` turns envelopes into the rows that `f` gets, such as typed records.
    """
    def wrap(f):
        return Job(f, payload, partitions or {}, overwrite, purge_versions, tuple(historical), person_tables or {},
                   parse_once, stage)
    return wrap
