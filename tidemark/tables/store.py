"""Maintenance rules of the structured zone.

Layout under `root`: `structured/<table>/` and `reports/level-<n>/<name>/`, each with the manifests of its versions (`commits`)
and the folders they name. Tables are gzip Parquet with hive partitions. An archived schema stays part of the manifest.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files
from .commits import WRITE, Commits, Version


def fill_partition_nulls(df: DataFrame, partitions) -> DataFrame:
    """Null partition values become -1 (numbers) or 'undefined' (anything else)."""
    for name in partitions:
        kind = df.schema[name].dataType
        if isinstance(kind, T.NumericType):
            df = df.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.lit(-1).cast(kind)))
        elif isinstance(kind, T.StringType):
            df = df.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.lit("undefined")))
        else:
            df = df.withColumn(name, F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("undefined")))
    return df


def verify_schema(old: T.StructType, old_parts, new: T.StructType, new_parts) -> bool:
    """Same partition keys, same columns (in any order), same types outside the partition keys."""
    if sorted(old_parts) != sorted(new_parts):
        return False
    if sorted(old.fieldNames()) != sorted(new.fieldNames()):
        return False
    return all(old[c].dataType == new[c].dataType for c in old.fieldNames() if c not in set(old_parts))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/structured/{name}"

    def commits(self, name: str) -> Commits:
        return Commits(self.spark, self.path(name))

    def exists(self, name: str) -> bool:
        return bool(self.commits(name).latest().writes)

    def partitions(self, name: str) -> list[str]:
        """Partition keys, outermost first."""
        return list(self.commits(name).latest().partitions)

    def folders(self, name: str) -> list[str]:
        """The folders that hold the rows of the newest version."""
        return [f"{self.path(name)}/{w}" for w in self.commits(name).latest().writes]

    def read(self, name: str) -> DataFrame:
        """The newest version of a table. Partition values keep the text they were written with."""
        found = self.folders(name)
        if not found:
            raise FileNotFoundError(self.path(name))
        return self.read_folders(found)

    def read_folders(self, folders: list[str]) -> DataFrame:
        """The rows of some folders of one layout."""
        with self._plain_partitions():
            reader = self.spark.read.option("basePath", folders[0].rpartition("/")[0])
            return reader.parquet(*folders).drop(WRITE)

    @contextmanager
    def _plain_partitions(self):
        setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "false")
        try:
            yield
        finally:
            self.spark.conf.set(setting, before)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def archived(self, name: str) -> list[str]:
        """Times at which a schema was archived, oldest first."""
        return [a["time"] for a in self.commits(name).latest().archived]

    def read_archived(self, name: str, time: str) -> DataFrame:
        """The rows that were archived at a time, with the schema they had."""
        found = next(a for a in self.commits(name).latest().archived if a["time"] == time)
        return self.read_folders([f"{self.path(name)}/{w}" for w in found["writes"]])

    def archive(self, name: str) -> str:
        """Put the table's rows away: it is empty then, and its rows are among the archived."""
        log = self.commits(name)
        while True:
            now = log.latest()
            if log.commit(self._archived(now)):
                return self.archived(name)[-1]

    def _archived(self, now: Version) -> Version:
        stamp = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        entry = {"time": stamp, "writes": list(now.writes), "schema": now.schema, "partitions": list(now.partitions)}
        return replace(now, number=now.number + 1, writes=(), archived=(*now.archived, entry))

    def _save(self, df: DataFrame, path: str, partitions=()) -> None:
        if partitions:
            # Rebalancing groups equal partition values and still splits an oversized one.
            df = df.hint("rebalance", *[F.col(f"`{p}`") for p in partitions])
        writer = df.write.mode("errorifexists").option("compression", "gzip")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(path)

    def write(self, df: DataFrame | None, name: str, partitions=(), overwrite: bool = False,
              purge_versions: bool = False, historical: bool = False, batch: str | None = None) -> str | None:
        """Write one output table by the rules; returns its name, or None when there was nothing to write.

        The rows go to a folder of their own and are shown by one commit, so they may be computed from the table they replace, and
        readers see the table before or after, never in between. If another writer commits first, the commit is made
        again on top of that version. With a `batch` name the call can be repeated after a failure: a stored batch is
        left alone, and one that was written completely is committed without being computed again.
        """
        log = self.commits(name)
        now = log.latest()
        if batch and now.has(batch):
            return name
        if df is None:
            return None
        partitions = list(partitions)
        df = fill_partition_nulls(df, partitions)
        if now.writes and sorted(now.partitions) == sorted(partitions):
            partitions = list(now.partitions)
        folder = log.new_write(df.schema, partitions, batch)
        path = f"{self.path(name)}/{folder}"
        if not (batch and files.exists(self.spark, f"{path}/_SUCCESS")):
            files.remove(self.spark, path)
            self._save(df, path, partitions)
        # Asking the written files is cheaper than computing the frame once more to see if it is empty.
        written = self.read_folders([path]) if files.has_data(self.spark, path) else None
        if written is None or written.isEmpty():
            files.remove(self.spark, path)
            return None
        while True:
            now = log.latest()
            if batch and now.has(batch):
                return name
            same = not now.writes or verify_schema(now.columns(), now.partitions, written.schema, partitions)
            base = now if same else self._archived(now)
            keep = base.writes if historical or not (overwrite or purge_versions) else ()
            purged = () if purge_versions and not historical else base.archived
            new = replace(base, number=now.number + 1, writes=(*keep, folder), schema=written.schema.json(),
                          partitions=tuple(partitions), archived=purged).with_batch(batch)
            if log.commit(new):
                return name

    def write_all(self, tables: dict[str, DataFrame | None], partitions: dict | None = None, overwrite=False,
                  purge_versions=False, historical=(), batch: str | None = None) -> list[str]:
        """Write every output table of one transform; returns the names that changed."""
        partitions = partitions or {}
        done = []
        for name, df in tables.items():
            if df is not None and not isinstance(df, DataFrame):
                raise TypeError("a transform must return DataFrames")
            done.append(self.write(df, name, partitions.get(name, ()), overwrite, purge_versions, name in historical,
                                   batch))
        return [name for name in done if name]

    # -- catalogue -----------------------------------------------------------------------

    def register(self, name: str, database: str) -> bool:
        """Make the level database show the newest version of the table; False when the database had the table already.

        The entry is a view over the folders of that version, so queries of the catalogue see whole versions too.
        """
        full = f"`{database}`.`{name}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/catalog/{database}'")
        known = self.spark.catalog.tableExists(f"{database}.{name}")
        found = self.folders(name)
        columns = ", ".join(f"`{c}`" for c in self.read_folders(found).columns)
        writes = ", ".join("'" + f.rpartition("=")[2] + "'" for f in found)
        with self._plain_partitions():  # a view keeps the settings it was made with
            self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {columns} FROM parquet.`{found[0].rpartition('/')[0]}` WHERE `{WRITE}` IN ({writes})")
        return not known

    # -- reports -------------------------------------------------------------------------

    def report_path(self, name: str, level: int) -> str:
        return f"{self.root}/reports/level-{level}/{name}"

    def materialize(self, name: str, df: DataFrame, level: int) -> str:
        """Store a report result; readers see the old one until the new one is complete."""
        target = self.report_path(name, level)
        log = Commits(self.spark, target)
        folder = log.new_write(df.schema, ())
        self._save(df, f"{target}/{folder}")
        while True:
            now = log.latest()
            if log.commit(replace(now, number=now.number + 1, writes=(folder,), schema=df.schema.json())):
                return target

    def has_report(self, name: str, level: int) -> bool:
        return bool(Commits(self.spark, self.report_path(name, level)).latest().writes)

    def drop_materialized(self, name: str, level: int) -> None:
        files.remove(self.spark, self.report_path(name, level))

    def cached_report(self, name: str, level: int, filters: dict | None = None) -> DataFrame:
        """A stored report, restricted by equality filters that reach the Parquet scan."""
        target = self.report_path(name, level)
        stored = Commits(self.spark, target).latest().writes
        if not stored:
            raise FileNotFoundError(target)
        df = self.read_folders([f"{target}/{w}" for w in stored])
        for column, value in (filters or {}).items():
            df = df.filter(F.col(column) == F.lit(value))
        return df


def level_database(stage: str, level: int) -> str:
    return f"{stage}_level_{level}_database"


def database_name(name: str | None, stage: str) -> str | None:
    """Full database name from a short one (`level_1`): stage in front, `_database` behind."""
    if not name:
        return None
    name = name if name.startswith(f"{stage}_") else f"{stage}_{name}"
    return name if name.endswith("_database") else f"{name}_database"
