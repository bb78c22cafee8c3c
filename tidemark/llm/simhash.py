"""SimHash near-duplicate detection by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import INNER, connected_components, keyed_join, staged, texts

SEED = 42
BITS = 64
#: Fingerprints that may share one segment value before that bucket is searched by the bounded keys instead.
BUCKET = 64


def fingerprint(text: bytes, size: int) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text: A-Z lower-cased, words between ASCII white space, shingles of `size` words
    with repeats, XXH64 each; a bit is set where more than half the hashes have it. No words: zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), SEED)
    shingles = zip(*(words[i:] for i in range(size)))
    hashes = np.fromiter((digest(b" ".join(s), SEED) for s in shingles), np.uint64, len(words) - size + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: Column, size: int = 3) -> Column:
    """The fingerprint as a signed long."""
    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        found = (fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size) for t in column)
        return pa.array(np.fromiter(found, np.uint64, len(column)).view(np.int64))

    return of(text)


def segments(distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the segments: fingerprints within `distance` differ by at most radius bits in one of them.

    Radii are 1 or 0: more segments instead of larger balls. The radii plus one each add up to distance + 1, so not all can be passed.
    """
    count = max(2, distance // 2 + 1)
    radii = [1] * (distance + 1 - count) + [0] * (2 * count - distance - 1)
    starts = [BITS * i // count for i in range(count + 1)]
    return [(BITS - b, b - a, r) for a, b, r in zip(starts, starts[1:], radii)]


def _masks(width: int, radius: int) -> list[int]:
    out = {0}
    for _ in range(radius):
        out |= {m ^ 1 << i for m in out for i in range(width)}
    return sorted(out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _value(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("long") for v in values])


def _lookups(i: int, shift: int, width: int, radius: int) -> Column:
    """The keys to look up for segment i: its own value, and those values of its Hamming ball that are larger."""
    value = _value(shift, width)
    upward = F.filter(_longs(_masks(width, radius)), lambda m: (m == 0) | (value.bitwiseXOR(m) > value))
    return F.transform(upward, lambda m: F.struct(
        F.lit(i).alias("segment"), value.bitwiseXOR(m).alias("value"), (m == 0).alias("same")))


def near_links(fingerprints: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links of distinct fingerprints (column `fp`), so that fingerprints within `distance` bits are connected.

    Multi-index hashing: one table per segment; the query side enumerates the Hamming ball around its segment, fetches the table's
    fingerprints of equal value and verifies the complete distance. Of a segment and its flips only the larger values are
    looked up, since the other end of the pair finds the rest. Any distance from 0 up; beyond 4 crowded buckets become dear.

    A bucket with more than `bucket` fingerprints would give all its pairs, so the fingerprints that touch one are linked
    exactly in another way: two of them are within 2r bits just when their balls of radius r share a member (2r + 1 bits: when they do
    after clearing one bit). At most as many fingerprints as a ball has members hold the same such key, and each is linked to the smallest of them.
    """
    if distance < 0:
        raise ValueError("distance must not be negative")
    if not distance:
        return fingerprints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("a != b")
    fp = F.col("fp")
    halves = segments(distance)
    entries = F.array(*[F.struct(F.lit(i).alias("segment"), _value(shift, width).alias("value"))
                        for i, (shift, width, _) in enumerate(halves)])
    table = fingerprints.select(fp, F.explode(entries).alias("k")).select("fp", "k.segment", "k.value")
    lookups = fingerprints.select(fp, F.explode(F.concat(*[_lookups(i, *h) for i, h in enumerate(halves)])).alias("k")).select(
        "fp", "k.segment", "k.value", "k.same")
    key = ["segment", "value"]
    full = staged(table.groupBy(key).count().filter(F.col("count") > bucket).select(key), "buckets")
    pairs = keyed_join(lookups.withColumnRenamed("fp", "a"), full, key, "left_anti").join(
        keyed_join(table.withColumnRenamed("fp", "b"), full, key, "left_anti"), key)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    links = pairs.filter(near & (~F.col("same") | (F.col("a") < F.col("b")))).select("a", "b")

    crowded = keyed_join(lookups.select("fp", *key), full, key, "left_semi").select("fp").union(
        keyed_join(table, full, key, "left_semi").select("fp")).distinct()
    ball = _masks(BITS, distance // 2)
    if distance % 2 == 0:
        keys = F.transform(_longs(ball), lambda m: F.struct(F.lit(0).cast("long").alias("bit"), fp.bitwiseXOR(m).alias("rest")))
    else:
        keys = F.flatten(F.transform(_longs(_masks(BITS, 1)[1:]), lambda bit: F.transform(_longs(ball), lambda m: F.struct(
            bit.alias("bit"), fp.bitwiseXOR(m).bitwiseAND(F.bitwise_not(bit)).alias("rest")))))
    members = crowded.select(fp, F.explode(keys).alias("k")).groupBy("k").agg(F.collect_set("fp").alias("fps"))
    stars = members.filter(F.size("fps") > 1).select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return links.union(stars.filter("a != b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of `docs`.

    Documents whose fingerprints differ by at most `distance` bits are linked; component_id is the smallest id that can be
    reached. Equal fingerprints count once in the search, so a third of all documents may be copies. Null texts are
    empty; texts without words have fingerprint zero and are linked like others. Null ids keep their row and are passed over for
    component_id (null if no other id is there). An empty table gives no rows; other columns are not read.
    """
    return _classes(docs, size, distance, id_column, text_column).select("doc_id", "fingerprint", "component_id")


def _classes(docs: DataFrame, size: int, distance: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, fingerprint, component_id, component): component tells classes apart, also those that begin with rows of one id."""
    prints = staged(texts(docs, id_column, text_column).select("doc_id", simhash(F.col("text"), size).alias("fp")), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = connected_components(near_links(distinct.select("fp"), distance), "a", "b").withColumnRenamed("node", "fp")
    labelled = staged(keyed_join(distinct, found, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")), "labels")
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = keyed_join(labelled.select("fp", "component"), smallest, "component")
    return keyed_join(prints, classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component")


def drop_near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2, id_column: str = "doc_id",
                         text_column: str = "text") -> DataFrame:
    """`docs` with one row per component: the one with the smallest id, then fingerprint, then hash of the row. All columns are kept.

    Rows without an id stay. Where an id is repeated its rows are told apart by their fingerprints, so a row goes only if it, not
    another of its id, is the near-duplicate; equal rows of one id leave one.
    """
    key, print_column, columns = f"{INNER}id", f"{INNER}fp", docs.columns
    near = staged(_classes(docs, size, distance, id_column, text_column).filter("doc_id IS NOT NULL"), "classes")
    pair = F.struct("doc_id", "fingerprint")
    pairs = near.groupBy("component").agg(F.min(pair).alias("first"))
    dropped = keyed_join(near, pairs, "component").filter(pair != F.col("first")).select(
        F.col("doc_id").alias(key), F.col("fingerprint").alias(print_column)).distinct()
    dropped = staged(dropped, "dropped")
    repeated = staged(near.groupBy(F.col("doc_id").alias(key)).count().filter(F.col("count") > 1).select(key), "repeated")
    docs = docs.withColumn(key, F.col(f"`{id_column}`"))
    once = keyed_join(docs, repeated, key, "left_anti")
    once = keyed_join(once, dropped.select(key), key, "left_anti")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    often = keyed_join(docs, repeated, key, "left_semi").withColumn(print_column, F.lower(F.lpad(F.hex(simhash(text, size)), 16, "0")))
    often = keyed_join(often, dropped, [key, print_column], "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    often = often.groupBy(key, print_column).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
    return once.select(*[F.col(f"`{c}`") for c in columns]).union(often.select(*[F.col(f"row.`{c}`") for c in columns]))
