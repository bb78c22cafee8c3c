"""Keyed state of streams, held in RocksDB stores beside the checkpoint: what a key has seen is found by the key alone."""

from __future__ import annotations

import math
from contextlib import contextmanager
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

#: Column with the number of rows that a combined row stands for.
ROWS = "_rows"
#: Keys a task combines at once.
HELD = 50_000

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; those of the session's other streams stay as set."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def ordered(value):
    """A value as something that sorts: nulls first, NaN last, parts of a record one after the other."""
    if value is None:
        return (0,)
    if isinstance(value, float):
        return (1, math.isnan(value), 0.0 if math.isnan(value) else value)
    if isinstance(value, dict):
        return (1, *(ordered(v) for v in value.values()))
    if isinstance(value, (list, tuple)):
        return (1, *(ordered(v) for v in value))
    return (1, value)


def _plain(column: pa.Array) -> bool:
    """Whether Arrow sorts a column as `ordered` does: no records or lists, and no NaN."""
    kind = column.type
    if pa.types.is_floating(kind):
        return not pc.any(pc.is_nan(column), min_count=0).as_py()
    return not (pa.types.is_nested(kind) or pa.types.is_null(kind))


def _smallest(batch: pa.RecordBatch, keys: list[str], columns: list[str]) -> pa.RecordBatch:
    """The smallest row of every key of a batch, and in ROWS the rows of that key; for columns that Arrow can sort."""
    order = pc.sort_indices(batch, sort_keys=[(c, "ascending") for c in dict.fromkeys([*keys, *columns])], null_placement="at_start")
    changed = np.zeros(batch.num_rows, bool)
    changed[:1] = True
    for k in keys:
        column = batch.column(k).take(order)
        here, before = column.slice(1), column.slice(0, len(column) - 1)
        differs = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
        changed[1:] |= differs.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(changed)
    rows = batch.select(columns).take(order.take(pa.array(starts)))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.diff(np.append(starts, batch.num_rows)), pa.int64())], [*columns, ROWS])


def smallest_in_task(stream: DataFrame, keys: list[str], only: str | None = None) -> DataFrame:
    """The smallest row of every key in each Arrow batch of the input, and in ROWS how many rows it stands for.

    Stateless; without it all rows of a hot key would go to one task. With `only`, a boolean column that ends here, other rows are left out:
    a filter before would be moved ahead of the watermark, which then would not see their time.
    """
    columns = [c for c in stream.columns if c != only]
    schema = T.StructType([*(stream.schema[c] for c in columns), T.StructField(ROWS, T.LongType())])

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        kind = None

        def flush():
            fields = [kind.field(c) for c in columns] + [pa.field(ROWS, pa.int64())]
            out = pa.RecordBatch.from_pylist([{**row, ROWS: n} for row, n in best.values()], pa.schema(fields))
            best.clear()
            return out

        for batch in batches:
            kind = batch.schema
            if only:
                batch = batch.filter(pc.fill_null(batch.column(only), False))
            if not batch.num_rows:
                continue
            if all(_plain(batch.column(c)) for c in columns):
                # keys that stand in several batches are passed several times; their state takes the smallest
                yield _smallest(batch, keys, columns)
                continue
            for row in batch.to_pylist():
                key = tuple(ordered(row[k]) for k in keys)
                found = best.get(key)
                if found is None:
                    best[key] = (row, 1)
                else:
                    smaller = min(found[0], row, key=lambda r: [ordered(r[c]) for c in columns])
                    best[key] = (smaller, found[1] + 1)
            if len(best) > HELD:
                yield flush()
        if best:
            yield flush()

    return stream.mapInArrow(combined, schema)


def smallest_in_partition(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of every key in each partition, so that after a shuffle by the keys one row of a key is left per batch.

    Holds the best row of each key of the partition, besides the rows that came since they were last combined.
    """
    columns = stream.columns

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, most = 0, HELD

        def best() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            if all(_plain(whole.column(c)) for c in columns):
                return pa.RecordBatch.from_arrays(_smallest(whole, keys, columns).columns[:-1], schema=whole.schema)
            kept: dict = {}
            for row in whole.to_pylist():
                key = tuple(ordered(row[k]) for k in keys)
                kept[key] = min(kept[key], row, key=lambda r: [ordered(r[c]) for c in columns]) if key in kept else row
            return pa.RecordBatch.from_pylist(list(kept.values()), whole.schema)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > most:
                held = [best()]
                size = held[0].num_rows
                most = 2 * size + HELD
        if held:
            yield best()

    return stream.mapInArrow(combined, stream.schema)


class OncePerPeriod(StatefulProcessor):
    """Keeps the smallest row of a period until its timer fires, passes it then, and never another; later rows are only counted.

    The column `closes` holds the time in milliseconds at which the watermark closes the period.
    """

    def __init__(self, schema: T.StructType, closes: str):
        self.schema, self.columns, self.closes = schema, schema.fieldNames(), closes

    def init(self, handle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)
        self.closed = handle.getValueState("closed", "at long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.closed.update((0,))

    def handleInputRows(self, key, rows, timerValues):
        if self.closed.exists():
            yield Row(**dict(zip(self.schema.fieldNames(), key)), **{c: None for c in self.columns[len(key):]}, late=sum(r[ROWS] for r in rows))
            return
        order = lambda r: [ordered(v) for v in r]
        found = [min((tuple(r[c] for c in self.columns) for r in rows), key=order)]
        if self.best.exists():
            found.append(tuple(self.best.get()))
        else:
            self.handle.registerTimer(dict(zip(self.columns, found[0]))[self.closes])
        self.best.update(min(found, key=order))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        best = tuple(self.best.get())
        self.best.clear()
        self.closed.update((timerValues.getCurrentWatermarkInMs(),))
        yield Row(**dict(zip(self.columns, best)), late=None)

    def close(self) -> None:
        pass
