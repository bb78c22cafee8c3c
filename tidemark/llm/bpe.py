"""Byte-level BPE encoding by merge replay over the words of a corpus slice, and decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

#: Characters of text whose new words are replayed together, and words a task remembers.
SLICE_CHARS = 3_000_000
REMEMBERED = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, which is also the merge rank, from lines of base64 and id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """All pairs of tokens that make a token, as sorted keys, and what is needed to replay them in rank order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.byte = np.full(256, -1, np.int32)
        found = []
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte[token[0]] = rank
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    found.append((a * self.size + b, rank))
        pairs = np.array(sorted(found) or [(-1, -1)], np.int64)
        self.keys, self.results = pairs[:, 0], pairs[:, 1].astype(np.int32)
        # tokens that may form a pair of lower rank than their own
        self.early = np.zeros(self.size, bool)
        left, right = np.divmod(np.maximum(self.keys, 0), self.size)
        for part in (left, right):
            self.early[part[self.results < part]] = True

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair merges to; NONE if nothing."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.results[at], NONE)


NONE = np.int32(2**31 - 1)


def _apart(pairs: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row (a a a), the first, third and so on: what a scan from the left would merge."""
    chained = np.concatenate([[False], seconds[:-1] == pairs[1:]])
    if not chained.any():
        return np.ones(len(pairs), bool)
    at = np.arange(len(pairs))
    return (at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """The token ids of every word, as the bytes of 32-bit numbers; all merges are replayed over the whole list.

    The words lie in one linked list of tokens. An inverted index leads from the rank of a token pair to the positions where
    the pair begins. Ranks are taken lowest first, each merged at all its positions at once, and only the two pairs next to a merge are
    looked up again and entered in the index. Where a merged token could form a pair of lower rank than its own, each word merges its
    first position only and the others wait, so every word sees its merges in the order in which it would be encoded alone.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    ends = lengths.cumsum()
    token = merges.byte[np.frombuffer(b"".join(words), np.uint8)]
    if (token < 0).any():
        raise ValueError("the vocabulary lacks a byte")
    n = len(token)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    after[ends - 1], before[ends - lengths] = -1, -1
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    pair = np.full(n, NONE, np.int32)
    inner = np.flatnonzero(after >= 0)
    pair[inner] = merges.rank(token[inner], token[inner + 1])
    index: dict[int, list[np.ndarray]] = {}
    pending: list[int] = []

    def enter(positions: np.ndarray) -> None:
        ranks = pair[positions]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        positions = positions[:np.searchsorted(ranks, NONE)]
        cuts = np.flatnonzero(ranks[1:len(positions)] != ranks[:len(positions) - 1]) + 1 if len(positions) else []
        begin = 0
        for end in [*cuts, len(positions)]:
            if end > begin:
                rank = int(ranks[begin])
                if rank in index:
                    index[rank].append(positions[begin:end])
                else:
                    index[rank] = [positions[begin:end]]
                    heappush(pending, rank)
            begin = end

    enter(inner)
    while pending:
        rank = heappop(pending)
        found = index.pop(rank)
        at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        at = at[pair[at] == rank]  # the others have lost a token to an earlier merge
        if not len(at):
            continue
        if merges.early[rank]:
            first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            if not first.all():
                index[rank] = [at[~first]]
                heappush(pending, rank)
                at = at[first]
        else:
            at = at[_apart(at, after[at])]
        second = after[at]
        third = after[second]
        follows = third >= 0
        token[at], token[second], pair[at], pair[second], after[at] = rank, -1, NONE, NONE, third
        before[third[follows]] = at[follows]
        here, left = at[follows], before[at]
        left = left[left >= 0]
        pair[here] = merges.rank(token[here], token[after[here]])
        pair[left] = merges.rank(token[left], token[after[left]])
        enter(np.unique(np.concatenate([here, left])))
    alive = token >= 0
    ids = token[alive].tobytes()
    stops = (np.cumsum(alive)[ends - 1] * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Encodes slices of documents; words seen before are not replayed again."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.merges = ranks, Merges(ranks)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, documents: list[str]) -> list[np.ndarray]:
        """The ids of each document."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, pieces = self.known, [self.split(d) for d in documents]
        merge, spelled = [], []
        for word in set().union(*pieces).difference(known):
            raw = word.encode()
            if raw in self.ranks:
                known[word] = np.int32(self.ranks[raw]).tobytes()
            else:
                merge.append(raw)
                spelled.append(word)
        if merge:
            known.update(zip(spelled, replay(merge, self.merges)))
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in pieces]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_CHARS bytes; a longer text is a slice of its own."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)), dtype=np.int64)
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_CHARS, "right")))
        yield start, stop
        start = stop


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids), one row per row of `docs`: the ids of the whole text, without special tokens.

    `path` names the rank file, which every executor must have; `pattern` splits a text into the words that are merged separately.
    Null texts are empty and give no ids, null ids keep their row, an empty table gives no rows; other columns are not read. The
    work is local to a row: no shuffle, and memory follows a slice of texts (or the longest text).
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(load_ranks(path), pattern)
            ids, column = batch.column(0), batch.column(1)
            for start, stop in _slices(column):
                values = encoder.encode(column.slice(start, stop - start).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))
                yield pa.RecordBatch.from_arrays([ids.slice(start, stop - start), lists], ["doc_id", "ids"])

    docs = texts(docs, id_column, text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(ids: Column, path: str) -> Column:
    """The bytes that token ids stand for; an id outside the vocabulary is an error, null ids give null."""
    @F.arrow_udf("binary")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = load_ranks(path)
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            spelled[rank] = token
        known = np.array([bool(token) for token in spelled])
        for column in columns:
            out = []
            for ids in column:
                numbers = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else None
                if numbers is not None and len(numbers) and not (
                        0 <= numbers.min() and numbers.max() < len(spelled) and known[numbers].all()):
                    raise ValueError("an id is not in the vocabulary")
                out.append(None if numbers is None else b"".join([spelled[i] for i in numbers.tolist()]))
            yield pa.array(out, pa.binary())

    return of(ids)
