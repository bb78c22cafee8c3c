"""Reports kept up to date from what was added: partial aggregates are stored and merged with those of new rows.

A view remembers which writes of its table it has taken in, as the table's manifests name them. A refresh reads only the writes that came since;
if some were replaced, or a fixed table or the view itself changed, it starts anew from all rows. Distinct counts and quantiles are sketches,
so that they merge as well: a theta sketch of 4,096 entries (standard error 1.6 %), a KLL sketch of k = 200 (rank error 1.4 %).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .commits import Commits
from .store import TableStore

#: Nominal entries of a distinct sketch as a power of two; k of a quantile sketch.
THETA, KLL = 12, 200

#: For every kind of measure: its partial columns with how they are computed and merged, and how they become the value.
KINDS: dict[str, tuple[dict[str, tuple[Callable, Callable]], Callable]] = {
    "sum": ({"s": (F.sum, F.sum)}, lambda p: p["s"]),
    "count": ({"n": (F.count, F.sum)}, lambda p: p["n"]),
    "min": ({"m": (F.min, F.min)}, lambda p: p["m"]),
    "max": ({"m": (F.max, F.max)}, lambda p: p["m"]),
    "average": ({"s": (F.sum, F.sum), "n": (F.count, F.sum)}, lambda p: F.try_divide(p["s"], p["n"])),
    "distinct": ({"t": (lambda c: F.theta_sketch_agg(c, THETA), lambda c: F.theta_union_agg(c, THETA))}, lambda p: F.theta_sketch_estimate(p["t"])),
    "median": ({"q": (lambda c: F.kll_sketch_agg_double(c.cast("double"), KLL), lambda c: F.kll_merge_agg_double(c, KLL))},
               lambda p: F.kll_sketch_get_quantile_double(p["q"], F.lit(0.5))),
}


@dataclass(frozen=True)
class View:
    """`measures` gives for every output column its kind and the column of the rows it is made of.

    `rows(delta, read)` turns rows of the table into rows to aggregate, row by row; it may join tables named in `fixed`, which `read` gives.
    """

    name: str
    table: str
    keys: tuple[str, ...]
    measures: dict[str, tuple[str, str]]
    rows: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame] = field(default=lambda delta, read: delta)
    fixed: tuple[str, ...] = ()

    def _columns(self) -> dict[str, tuple[str, Callable, Callable]]:
        return {f"{out}__{part}": (column, first, merged) for out, (kind, column) in self.measures.items()
                for part, (first, merged) in KINDS[kind][0].items()}

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[first(F.col(c)).alias(p) for p, (c, first, _) in self._columns().items()])

    def merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        return one.unionByName(other).groupBy(*self.keys).agg(*[merge(F.col(p)).alias(p) for p, (_, _, merge) in self._columns().items()])

    def values(self, partials: DataFrame) -> DataFrame:
        def value(out: str, kind: str) -> Column:
            return KINDS[kind][1]({part: F.col(f"{out}__{part}") for part in KINDS[kind][0]})

        return partials.select(*self.keys, *[value(out, kind).alias(out) for out, (kind, _) in self.measures.items()])

    def shape(self) -> str:
        return hashlib.sha1(repr((self.table, self.keys, sorted(self.measures.items()), self.fixed)).encode()).hexdigest()


def _log(store: TableStore, view: View) -> Commits:
    return Commits(store.spark, f"{store.root}/views/{view.name}")


def refresh(store: TableStore, view: View) -> dict:
    """Bring a view up to the newest version of its table; returns how many writes were read and whether from scratch."""
    log = _log(store, view)
    while True:
        old, table = log.latest(), store.commits(view.table).latest()
        fixed = {t: store.commits(t).latest().number for t in view.fixed}
        seen = old.notes.get("writes", [])
        more = bool(old.writes) and old.notes["shape"] == view.shape() and old.notes["fixed"] == fixed and set(seen) <= set(table.writes)
        todo = [w for w in table.writes if not (more and w in set(seen))]
        if not todo:
            return {"writes": 0, "full": False}
        delta = store.read_folders([f"{store.path(view.table)}/{w}" for w in todo])
        partials = view.partial(view.rows(delta, store.read))
        if more:
            partials = view.merged(store.read_folders([f"{log.folder}/{w}" for w in old.writes]), partials)
        folder = log.new_write(partials.schema, ())
        partials.write.option("compression", "gzip").parquet(f"{log.folder}/{folder}")
        notes = {"writes": list(table.writes), "shape": view.shape(), "fixed": fixed}
        if log.commit(replace(old, number=old.number + 1, writes=(folder,), schema=partials.schema.json(), notes=notes)):
            return {"writes": len(todo), "full": not more}


def read(store: TableStore, view: View) -> DataFrame:
    """The values of a view as of its last refresh."""
    log = _log(store, view)
    stored = log.latest()
    if not stored.writes:
        raise FileNotFoundError(log.folder)
    return view.values(store.read_folders([f"{log.folder}/{w}" for w in stored.writes]))
