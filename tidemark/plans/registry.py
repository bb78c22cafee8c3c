"""Running stored reports: materialise, refresh on change, delete."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.governance import dependents, is_select, relations, remove, touch, upsert
from ..session import shuffles_removed
from ..tables.store import TableStore
from .catalogue import CATALOGUE, REGISTRY, run_report


def stored_sql(store: TableStore, today: date | None = None):
    """Runs the SQL of a registry row; a built-in report is a view over the stored tables by the report's name, and stored tables are views by theirs."""
    def run(name: str, sql: str) -> DataFrame:
        for table in {p[-1] for p in relations(store.spark, sql) or [] if len(p) == 1}:
            if store.exists(table):
                store.read(table).createOrReplaceTempView(f"`{table}`")
        if name in CATALOGUE and f"`{name}`" in sql:
            run_report(name, store.read, today or date.today()).createOrReplaceTempView(f"`{name}`")
        return store.spark.sql(sql)

    return run


def export_reports(registry: DataFrame, path: str) -> None:
    """The registry as files of one JSON object per report."""
    registry.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def import_reports(registry: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """Add the reports of exported files; a broken file fails, a statement that does more than read is refused."""
    new = registry.sparkSession.read.schema(REGISTRY).option("mode", "FAILFAST").json(path)
    refused = F.raise_error(F.concat(F.lit("not a SELECT: "), F.coalesce("name", F.lit("?"))))
    return upsert(registry, new.withColumn("queryString", F.when(is_select("queryString"), F.col("queryString")).otherwise(refused)), replace)


def report_tables(registry: DataFrame) -> DataFrame:
    """Stored reports as catalogue rows (database, table), so that reports over reports have a lineage and inherit their level."""
    return registry.select(F.concat(F.lit("reports_level_"), F.col("dataProtection").cast("string")).alias("database"), F.col("name").alias("table"))


class Graph:
    """Which stored reports read which others; names and levels only."""

    def __init__(self, store: TableStore, registry: DataFrame):
        self.store = store
        self.levels: dict[str, int] = {}
        tables: dict[str, set[str]] = {}
        for row in registry.select("name", "dataProtection", F.coalesce("tables", F.array().cast("array<string>")).alias("tables")).toLocalIterator():
            self.levels[row["name"]] = row["dataProtection"]
            tables[row["name"]] = set(row["tables"])
        self.reads = {name: {t for t in found if t in tables} for name, found in tables.items()}

    def waves(self, names: set[str]) -> list[list[str]]:
        """Those reports, the reports that read them, and unstored ones that they read, each wave reading only earlier ones."""
        readers: dict[str, set[str]] = {}
        for name, found in self.reads.items():
            for other in found:
                readers.setdefault(other, set()).add(name)
        needed, todo = set(), list(names)
        while todo:
            name = todo.pop()
            if name in needed:
                continue
            needed.add(name)
            todo.extend(readers.get(name, ()))
            todo.extend(o for o in self.reads[name] if not self.store.has_report(o, self.levels[o]))
        order = TopologicalSorter({n: self.reads[n] & needed for n in needed})
        try:
            order.prepare()
        except CycleError as error:
            raise ValueError(f"reports read each other: {', '.join(error.args[1])}") from None
        found = []
        while order.is_active():
            wave = order.get_ready()
            found.append(sorted(wave))
            order.done(*wave)
        return found

    def show(self, name: str) -> None:
        """Views of the reports that a report reads; one of a higher level is refused."""
        for other in self.reads[name]:
            if self.levels[other] > self.levels[name]:
                raise PermissionError(f"{name} has level {self.levels[name]} and reads {other} of level {self.levels[other]}")
            self.store.cached_report(other, self.levels[other]).createOrReplaceTempView(f"`{other}`")


def refresh(store: TableStore, registry: DataFrame, changed: DataFrame, run, now: str, at_once: int = 4) -> tuple[DataFrame, list[str]]:
    """Recompute the reports that read a changed table, directly or through other reports; returns the updated registry and the names, in order.

    `run(name, sql)` gives a report's DataFrame, by default as `stored_sql` does. Reports are computed in waves, each after the reports it
    reads, up to `at_once` of a wave as Spark jobs side by side; they see each other's new results by their names. Reports
    that read each other are refused before anything runs. Names, levels and SQL texts pass the driver, never results.
    """
    run = run or stored_sql(store)
    graph = Graph(store, registry)
    waves = graph.waves({r["name"] for r in dependents(registry, changed).toLocalIterator()})
    done = [name for wave in waves for name in wave]
    spark = registry.sparkSession
    refreshed = spark.createDataFrame([(n,) for n in done], "name STRING")
    texts = {r["name"]: r["queryString"] for r in registry.join(refreshed, "name", "left_semi").select("name", "queryString").toLocalIterator()}

    def compute(name: str) -> None:
        graph.show(name)
        store.materialize(name, run(name, texts[name]), graph.levels[name])

    with shuffles_removed(spark), ThreadPoolExecutor(at_once) as pool:
        for wave in waves:
            for job in [pool.submit(compute, name) for name in wave]:
                job.result()
    return touch(registry, refreshed, now), done


def refresh_one(store: TableStore, registry: DataFrame, name: str, run, now: str) -> DataFrame:
    """Compute one report, for example a new one; an unknown name is an error."""
    row = registry.filter(F.col("name") == name).head()
    if row is None:
        raise KeyError(f"no report named {name}")
    run = run or stored_sql(store)
    Graph(store, registry).show(name)
    store.materialize(name, run(name, row["queryString"]), row["dataProtection"])
    return touch(registry, registry.filter(F.col("name") == name), now)


def delete(store: TableStore, registry: DataFrame, name: str) -> DataFrame:
    """Forget a report and drop its materialisation."""
    row = registry.filter(F.col("name") == name).head()
    if row is None:
        raise KeyError(f"no report named {name}")
    store.drop_materialized(name, row["dataProtection"])
    return remove(registry, registry.filter(F.col("name") == name))
