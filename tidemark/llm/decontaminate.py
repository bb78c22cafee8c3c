"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import INNER, small_batches, staged

#: Shortest tile in words, share of an item's words that tiles must cover, bytes of benchmark text searched in one pass.
LEAST, COVERAGE, BLOCK_BYTES = 5, 0.8, 8 << 20
#: Base of the rolling hash (modulo 2^64), an odd constant.
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))

_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def rolling(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `size` tokens."""
    count = len(tokens) - size + 1
    out = np.zeros(max(count, 0), np.uint64)
    for i in range(size if count > 0 else 0):
        out = out * BASE + tokens[i:i + count].astype(np.uint64) + np.uint64(1)
    return out


class Windows:
    """Hashes of all windows of any length of a token sequence: differences of one running sum."""

    def __init__(self, tokens: np.ndarray):
        steps = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(tokens), BASE)]), dtype=np.uint64)
        mixed = (tokens.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * steps[:-1], dtype=np.uint64)])
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(tokens), BACK)]), dtype=np.uint64)

    def free(self, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the windows of `size` tokens that are free throughout, by place."""
        taken = np.concatenate([[0], np.cumsum(~free)])
        places = np.flatnonzero(taken[size:] == taken[:-size])
        return places, (self.sums[places + size] - self.sums[places]) * self.back[places]


def tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest match whose tokens are all unmarked becomes a tile and is marked, again and again.

    The greatest length at which unmarked windows of both still agree is found by halving, with Karp-Rabin hashes; all matches of that
    length are marked before a shorter one is looked for. Windows of equal hash are compared token by token. Equal
    lengths: the earlier place in the item, then in the text. Negative tokens equal nothing. Memory is linear in both sequences, however often
    tokens repeat.
    """
    free_item, free_text = item >= 0, text >= 0
    own, theirs = Windows(item), Windows(text)
    out: list[tuple[int, int, int]] = []

    def equal(p: int, t: int, size: int) -> bool:
        return bool((item[p:p + size] == text[t:t + size]).all())

    def shared(size: int):
        """Places in the item of windows of this size that the text has too, with the places of equal hash there."""
        places, hashes = own.free(free_item, size)
        others, found = theirs.free(free_text, size)
        order = np.argsort(found, kind="stable")
        found, others = found[order], others[order]
        low, high = np.searchsorted(found, hashes, "left"), np.searchsorted(found, hashes, "right")
        hit = np.flatnonzero(low < high)
        return [(places[i], low[i], high[i]) for i in hit], others

    def any_shared(size: int) -> bool:
        found, others = shared(size)
        return any(equal(p, others[t], size) for p, low, high in found for t in range(low, high))

    most = min(len(item), len(text))
    while most >= least:
        low, high = least - 1, most  # a match of size `low` exists (or is too short), none above `high`
        while low < high:
            middle = (low + high + 1) // 2
            if any_shared(middle):
                low = middle
            else:
                high = middle - 1
        size = low
        if size < least:
            break
        found, others = shared(size)
        passed: dict[int, int] = {}
        for p, first, end in found:
            # windows were free when this size began: tiles of the same size cover one of their ends or nothing
            if not (free_item[p] and free_item[p + size - 1]):
                continue
            at, gone = passed.get(first, first), True
            for i in range(at, end):
                t = others[i]
                if not (free_text[t] and free_text[t + size - 1]):
                    at = i + 1 if gone else at
                    continue
                if equal(p, t, size):
                    free_item[p:p + size] = free_text[t:t + size] = False
                    out.append((int(p), int(t), size))
                    at = i + 1 if gone else at
                    break
                gone = False
            passed[first] = at
        most = size - 1
    return out


class Index:
    """The seeds (windows of LEAST words) of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        self.ids = [i for i, _ in items]
        self.items = [np.array([number(w, len(self.vocabulary)) for w in words(t)], np.int64) for _, t in items]
        hashes = [rolling(x, least) for x in self.items]
        self.owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        self.seeds = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owner = self.seeds[order], self.owner[order]

    def search(self, text: str) -> list[dict]:
        """The items of which tiles cover enough of the words: by item id."""
        get = self.vocabulary.get
        tokens = np.array([get(w, -1) for w in words(text)], np.int64)
        if len(tokens) < self.least or not len(self.seeds):
            return []
        hashes = rolling(tokens, self.least)
        place = np.searchsorted(self.seeds, hashes)
        place[place == len(self.seeds)] = 0
        hit = self.seeds[place] == hashes
        if not hit.any():
            return []
        # only words under a seed can be in a tile; gaps become a token that equals nothing
        under = np.zeros(len(tokens), bool)
        for i in range(self.least):
            under[i:i + len(hit)] |= hit
        near = under | np.concatenate([[False], under[:-1]])
        part = np.where(under, tokens, -1)[near]
        found = np.unique(hashes[hit])
        owners = {int(o) for h in found for o in self.owner[np.searchsorted(self.seeds, h, "left"):np.searchsorted(self.seeds, h, "right")]}
        out = []
        for o in sorted(owners, key=lambda o: (True, o) if self.ids[o] is None else (False, self.ids[o], o)):
            item = self.items[o]
            shared = np.isin(rolling(item, self.least), found)
            most = np.zeros(len(item), bool)
            for i in range(self.least):
                most[i:i + len(shared)] |= shared
            if most.sum() < self.coverage * len(item):
                continue
            matched = sum(n for _, _, n in tiles(item, part, self.least))
            if matched >= self.coverage * len(item):
                out.append({"item_id": self.ids[o], "matched": matched, "words": len(item)})
        return out


def hits_type(item_id: T.DataType) -> T.ArrayType:
    """Of the array of found items, whose ids are of any type."""
    return T.ArrayType(T.StructType([T.StructField("item_id", item_id), T.StructField("matched", T.IntegerType()), T.StructField("words", T.IntegerType())]))


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, id_column: str = "item_id", text_column: str = "text") -> Iterator[list]:
    """The items (id, text), distinct, in lists of about `block_bytes`: what is sent to the executors at once is bounded."""
    items = benchmark.select(F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{text_column}`").alias("text")).dropna(
        subset=["text"]).distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for b in range(count):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).collect()]


def with_hits(docs: DataFrame, benchmark: DataFrame, column: str, coverage: float = COVERAGE, least: int = LEAST,
              text_column: str = "text", block_bytes: int = BLOCK_BYTES, item_column: str = "item_id") -> DataFrame:
    """`docs` with an array column of (item_id, matched, words) for every benchmark item that a text contains.

    Texts and items are lower-cased word sequences. Seeds of `least` words that both share lead to candidate items; greedy string
    tiling then counts the words of the item that tiles of `least` words or more cover, in whatever order they stand. An item is
    contained from a share of `coverage` up. Items of fewer than `least` words have no seed and are never contained.

    Work is local to a row. The benchmark is taken in blocks of bounded size, one pass each; between two passes documents are staged.
    Null texts are empty; null item texts are passed over; repeated items count once; an empty benchmark gives empty arrays.
    """
    kind = hits_type(benchmark.schema[item_column].dataType)
    docs, found = small_batches(docs), F.array().cast(kind)
    for b, items in enumerate(blocks(benchmark, block_bytes, item_column)):
        if b:
            docs = staged(docs.withColumn(column, found), "hits")
            found = F.col(f"`{column}`")
        sent = docs.sparkSession.sparkContext.broadcast(items)
        found = F.concat(found, _search(F.col(f"`{text_column}`"), sent, least, coverage, kind))
    return docs.withColumn(column, found)


def _search(text: Column, sent, least: int, coverage: float, hits: T.ArrayType) -> Column:
    kind = to_arrow_type(hits)

    @F.arrow_udf(hits)
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(sent.value, least, coverage)
        for column in columns:
            yield pa.array([index.search(t.as_py() or "") for t in column], kind)

    return of(text)


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", full: bool = False, **how) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, coverage), one row per row of `docs`: the item with the highest coverage (equal: the
    smallest id), nulls where there is none. Rules as in `with_hits`. `full` adds `hits`: (item_id, matched, words) of all items, by id.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{how.pop('text_column', 'text')}`").alias("text"))
    hits = with_hits(rows, benchmark, "hits", **how)
    share = lambda h: h["matched"] / h["words"]
    hits = hits.withColumn("coverage", F.array_max(F.transform("hits", share)))
    best = F.array_min(F.transform(F.filter("hits", lambda h: share(h) == F.col("coverage")), lambda h: h["item_id"]))
    return hits.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").alias("n_items"), best.alias("item_id"),
                       "coverage", *([F.sort_array("hits").alias("hits")] if full else []))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """`docs` without the rows that contain a benchmark item; all columns kept, no shuffle."""
    column = f"{INNER}hits"
    return with_hits(docs, benchmark, column, **how).filter(F.size(column) == 0).drop(column)
