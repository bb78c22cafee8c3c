"""Phrase collocation mining by SON partitioning: shards mined at lowered support, candidates counted exactly over everything."""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import INNER, drop_staged, keyed_join, small_batches, staged

#: Shards of the corpus; bytes of text a task works on at once; keys a task combines before it hands them on.
SHARDS, SLICE, HELD = 2, 2_000_000, 4_000_000
#: Bits of a filter per key that it holds, and the most bits of one (32 MB). A full filter only lets more through.
FILTER_BITS, MOST_BITS = 16, 1 << 28

#: By byte: 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\v\f\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ODD = np.random.default_rng(12).integers(1 << 62, 1 << 63, 512, np.uint64) | np.uint64(1)
_BYTE, _STEP, _PLACE = _ODD[:256], _ODD[256], _ODD[257:261]
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """_STEP ** i modulo 2 ** 64 and its inverse, for i up to `size`."""
    if not _POWERS or len(_POWERS[0]) < size:
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]), dtype=np.uint64) for base in (_STEP, inverse)]
    return _POWERS[0], _POWERS[1]


class Words:
    """The words of several texts: hashes, the text each belongs to, and whether the next words follow in the same piece.

    `raw` holds the words with one space after each, so that a phrase is a range of it.
    """

    def __init__(self, texts: list[bytes]):
        buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _KIND[buffer]
        inside = kind == 0
        edges = np.flatnonzero(np.concatenate([inside[:1], inside[1:] != inside[:-1]]))
        starts, ends = edges[::2], edges[1::2]
        lengths = ends - starts
        self.count = len(starts)
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        self.lengths = lengths
        self.at = np.cumsum(lengths + 1) - lengths - 1
        raw = _LOWER[buffer]
        raw[ends] = 32
        inside[ends] = True
        self.raw = raw[inside]
        forward, back = _powers(len(self.raw))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[self.raw] * forward[:len(self.raw)], dtype=np.uint64)])
        self.hashes = mix((sums[self.at + lengths] - sums[self.at]) * back[self.at] + lengths.astype(np.uint64))

    def phrases(self, size: int) -> np.ndarray:
        """First words of all phrases of `size` words within a piece."""
        last = self.count - size + 1
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1:]) if last > 0 else np.zeros(0, np.int64)

    def keys(self, first: np.ndarray, size: int, salt: np.ndarray) -> np.ndarray:
        """A 64-bit key of each phrase under `salt` (one for every text)."""
        total = salt[self.text[first]]
        for i in range(size):
            total = total + self.hashes[first + i] * _PLACE[i % 4] + np.uint64(i)
            total = mix(total)
        return total

    def written(self, first: np.ndarray, size: int) -> pa.Array:
        """The phrases themselves, words joined by one space."""
        starts = self.at[first]
        lengths = self.at[first + size - 1] + self.lengths[first + size - 1] - starts
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = self.raw[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)]
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))

    def ids(self, salt: np.ndarray) -> np.ndarray:
        """A number for every word, equal for equal words of texts of equal salt: by hash, with the bytes compared."""
        keys = self.keys(np.arange(self.count), 1, salt)
        _, first, ids = np.unique(keys, return_index=True, return_inverse=True)
        like = first[ids]
        same = (self.lengths[like] == self.lengths) & (salt[self.text[like]] == salt[self.text])
        lengths = np.where(same, self.lengths, 0)
        ends = np.cumsum(lengths)
        inner = np.arange(int(ends[-1]) if self.count else 0) - np.repeat(ends - lengths, lengths)
        differs = self.raw[np.repeat(self.at, lengths) + inner] != self.raw[np.repeat(self.at[like], lengths) + inner]
        same[np.repeat(np.arange(self.count), lengths)[differs]] = False
        others: dict[tuple, int] = {}
        for i in np.flatnonzero(~same):
            word = (int(salt[self.text[i]]), self.raw[self.at[i]:self.at[i] + self.lengths[i]].tobytes())
            ids[i] = others.setdefault(word, len(first) + len(others))
        return ids


def _cut(text: bytes) -> Iterator[bytes]:
    """A very long text in parts that end where a piece ends."""
    while len(text) > SLICE:
        ends = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, SLICE)] == 2)
        if not len(ends):
            more = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8)[SLICE:]] == 2)
            ends = more[:1] + SLICE if len(more) else np.array([len(text) - 1])
        yield text[:ends[-1] + 1]
        text = text[ends[-1] + 1:]
    yield text


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int], Words]]:
    """(languages, shards, words) of a bounded number of bytes at a time."""
    langs, shards, texts, size = [], [], [], 0
    for batch in batches:
        for lang, shard, text in zip(*(c.to_pylist() for c in batch.columns)):
            for part in _cut(text.encode()):
                if texts and size + len(part) > SLICE:
                    yield langs, shards, Words(texts)
                    langs, shards, texts, size = [], [], [], 0
                langs.append(lang)
                shards.append(shard)
                texts.append(part)
                size += len(part)
    if texts:
        yield langs, shards, Words(texts)


def _salts(langs: list[str]) -> np.ndarray:
    """What sets languages apart in a key."""
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in set(langs)}
    return mix(np.array([known[x] for x in langs], np.uint64) * _PLACE[0])


def _shard_marks(shards: int) -> np.ndarray:
    """What sets shards apart: a key of a shard is the phrase's key XOR the shard's mark."""
    return mix(np.arange(1, shards + 1, dtype=np.uint64) * _PLACE[1])


class Filter:
    """A Bloom filter of bounded size over 64-bit keys: holds all that was put in (`many` at most), and by chance a few others."""

    def __init__(self, keys: DataFrame, many: int):
        self.bits = min(MOST_BITS, max(1 << 16, 1 << (many * FILTER_BITS).bit_length()))
        places = F.array(F.col("key").bitwiseAND(F.lit(self.bits - 1)), F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(self.bits - 1)))
        cells = keys.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 6).alias("cell")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        found = cells.toArrow()
        self.cells = np.zeros(self.bits >> 6, np.uint64)
        self.cells[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in (keys & np.uint64(self.bits - 1), keys >> np.uint64(32) & np.uint64(self.bits - 1)):
            out &= (self.cells[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _combined(kinds: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(key, shard, n) of (shard, keys), equal keys counted together as far as a task holds them."""
    held: dict[int, list] = {}
    size = 0

    def flush():
        for shard, arrays in held.items():
            keys, n = np.unique(np.concatenate(arrays), return_counts=True)
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000].view(np.int64)
                yield pa.record_batch([pa.array(part), pa.array(np.full(len(part), shard, np.int32)),
                                       pa.array(n[at:at + 100_000], pa.int64())], ["key", "shard", "n"])
        held.clear()

    for shard, keys in kinds:
        held.setdefault(shard, []).append(keys)
        size += len(keys)
        if size > HELD:
            yield from flush()
            size = 0
    if size:
        yield from flush()


def mine(rows: DataFrame, size: int, support: int, shards: int, shorter: tuple["Filter", "Filter"] | None) -> DataFrame:
    """(key, shard, n): keys of the phrases of `size` words that occur `support` times in their shard. Phrases whose first or last words (one less) are not frequent in the shard, or not
    candidates in the whole, are left out before anything is shuffled. Equal keys of different phrases would only add candidates.
    """
    marks = _shard_marks(shards)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kinds():
            for langs, shard_of, words in _slices(batches):
                salt, shard = _salts(langs), np.array(shard_of)[words.text]
                first = words.phrases(size)
                if shorter is not None:
                    local, whole = shorter
                    part = np.zeros(words.count + 1, bool)
                    at = words.phrases(size - 1)
                    keys = words.keys(at, size - 1, salt)
                    part[at] = local.holds(keys ^ marks[shard[at]]) & whole.holds(keys)
                    first = first[part[first] & part[first + 1]]
                keys = words.keys(first, size, salt)
                for s in range(shards):
                    here = shard[first] == s
                    if here.any():
                        yield s, keys[here] ^ marks[s]

        yield from _combined(kinds())

    found = rows.mapInArrow(of, "key long, shard int, n long").groupBy("key", "shard").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= support)


def united(mined: DataFrame, support: int, local: int, shards: int) -> DataFrame:
    """(key) of the candidates for the whole: frequent in a shard, and with `support` occurrences if every other shard had the most it can have
    without the phrase being frequent there.
    """
    marks = F.array(*[F.lit(int(m)).cast("long") for m in _shard_marks(shards).view(np.int64)])
    plain = mined.select(F.col("key").bitwiseXOR(F.get(marks, F.col("shard"))).alias("key"), "n")
    most = F.sum("n") + (shards - F.count("*")) * (local - 1)
    return plain.groupBy("key").agg(most.alias("most")).filter(F.col("most") >= support).select("key")


def count(rows: DataFrame, filters: list[Filter]) -> DataFrame:
    """(lang, size, phrase, a): exact occurrences, over all shards, of every candidate whose parts are candidates; as size 0 all words."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for langs, _, words in _slices(batches):
            for lang, n in zip(langs, np.bincount(words.text, minlength=len(langs)).tolist()):
                totals[lang] = totals.get(lang, 0) + n
            names, salt = pa.array(langs, pa.string()), _salts(langs)
            ids = words.ids(salt)
            many = int(ids.max()) + 1 if words.count else 1
            code = ids
            for size, kept in enumerate(filters, 1):
                first = words.phrases(size)
                if size > 1:
                    first = first[chain[first] & chain[first + 1]]
                first = first[kept.holds(words.keys(first, size, salt))]
                if size > 1:
                    code = code[first] * many + ids[first + size - 1]
                else:
                    code = code[first]
                _, example, like, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                chain = np.zeros(words.count + 1, bool)
                chain[first] = True
                code = np.zeros(words.count, np.int64)
                code[first] = like
                example = first[example]
                for at in range(0, len(example), 100_000):
                    part = example[at:at + 100_000]
                    yield pa.record_batch([names.take(pa.array(words.text[part])), pa.array(np.full(len(part), size, np.int32)),
                                           words.written(part, size), pa.array(n[at:at + 100_000], pa.int64())], ["lang", "size", "phrase", "a"])
        if totals:
            yield pa.record_batch([pa.array(list(totals), pa.string()), pa.array([0] * len(totals), pa.int32()), pa.array([""] * len(totals), pa.string()),
                                   pa.array(list(totals.values()), pa.int64())], ["lang", "size", "phrase", "a"])

    return rows.mapInArrow(of, "lang string, size int, phrase string, a long").groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))


def _part(first, size) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, support: int = 10, longest: int = 3, inside: int = 50, top: int = 2000, shards: int = SHARDS,
                 lang_column: str = "lang", text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the `top` phrases of 2 to `longest` words by score, a (both descending) and phrase.

    Texts are split into pieces at `.,;:!?` and line ends, pieces into words at spaces and tabs, A-Z lower-cased. a counts the
    occurrences within pieces (at least `support`), n all words of the language, l and r the two parts of the cut with the lowest score floor(1000000 * a * a /
    (l * r)) (ties: the earliest cut). Phrases that lie inside a longer one with `inside` percent of their occurrences are dropped.

    A phrase with `support` occurrences has at least support / shards in one of the shards, so none is missed wherever a row
    lies. Null texts are empty, null languages `und`, repeated rows count each time, an empty table gives no rows; other columns are not read.
    """
    rows = small_batches(docs).select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(f"`{id_column}`"), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    local = -(-support // shards)
    shorter, filters = None, []
    for size in range(1, longest + 1):
        mined = staged(mine(rows, size, local, shards, shorter), f"mined-{size}")
        many = mined.count()
        filters.append(Filter(united(mined, support, local, shards), many))
        if size < longest:
            shorter = (Filter(mined.select("key"), many), filters[-1])
        drop_staged(mined)
    counted = staged(count(rows, filters).filter((F.col("a") >= support) | (F.col("size") == 0)).withColumn("words", F.split("phrase", " ")), "counted")
    totals = counted.filter("size = 0").select(F.col("lang").alias(f"{INNER}lang"), F.col("a").alias("n"))

    candidates = counted.filter("size > 1")
    parts = counted.filter("size > 0").select("lang", "phrase", "a")
    cuts = candidates.select("lang", "size", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", _part(1, F.col("k"))).withColumn("right", _part(F.col("k") + 1, F.col("size"))).drop("words")
    cuts = keyed_join(cuts, parts.withColumnsRenamed({"phrase": "left", "a": "l"}), ["lang", "left"])
    cuts = keyed_join(cuts, parts.withColumnsRenamed({"phrase": "right", "a": "r"}), ["lang", "right"])
    exact = cuts.select("lang", "phrase", "a", "k", "l", "r", *[F.col(c).cast("decimal(16,0)").alias(f"{INNER}{c}") for c in "alr"])
    exact = exact.withColumn("score", F.expr(f"(cast(1000000 as decimal(7,0)) * {INNER}a * {INNER}a) div ({INNER}l * {INNER}r)"))
    scored = exact.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.filter("size > 2").select("lang", "a", F.explode(F.array(
        _part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = keyed_join(scored, longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).select("lang", "phrase", "a", "cut.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every language and part of the phrases first, so that one language is spread over many tasks
    dealt = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    best = left.withColumn("part", dealt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col(f"{INNER}lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
