"""Spelling variant grouping: a trie of letter counts, searched depth first with a budget of one letter more and one less."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, keyed_join, small_batches, staged

#: Levels of the trie: the count of each of these letters, then of the other letters in groups by code point. Common letters part most words.
LETTERS, OTHERS = "etaoinsrhldcumfpgwybvkxjqz", 6
LEVELS = len(LETTERS) + OTHERS
#: Levels that the distributed search goes down at a time; words of a subtree that one task searches; pairs that are compared at once.
STEP, BOUND, FEW = 4, 8192, 48
#: Different words a task holds before it hands their counts on.
HELD = 400_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GROUP = {ord(c): i for i, c in enumerate(LETTERS)}
#: A count is one character; higher counts look alike, which only makes the search less narrow.
_FIRST, _LAST = 0x21, 0xD000


def spelt(doc_id: str, text: str, slip: int = 97) -> Counter:
    """Occurrences of the words of a text: runs of Latin letters, A-Z lower-cased; where `slip` divides the CRC-32 h of `doc_id:run`, without
    their code point h % length.
    """
    runs = Counter(_RUN.findall(text.encode().lower().decode()))
    start, crc, out = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32, runs
    for run in [r for r in runs if crc(r.encode(), start) % slip == 0]:
        if out is runs:
            out = runs.copy()
        at = crc(run.encode(), start) % len(run)
        out[run] -= runs[run]
        out[run[:at] + run[at + 1:]] += runs[run]
    return out


def word_counts(docs: DataFrame, least_letters: int = 5, least: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of the words with enough code points and occurrences over all documents. Null texts have none, a null id is the empty text."""
    rows = small_batches(docs).select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")), F.col(f"`{text_column}`")).dropna()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            kept = [(w, n) for w, n in held.items() if n and len(w) >= least_letters]
            held.clear()
            return pa.record_batch([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(spelt(doc_id, text))
                if len(held) > HELD:
                    yield flush()
        yield flush()

    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def vector(word: str) -> str:
    """The path of a word: its letter counts in the order of the levels, one character each."""
    counts = [0] * LEVELS
    for c in word:
        point = ord(c)
        at = _GROUP.get(point)
        counts[len(LETTERS) + point % OTHERS if at is None else at] += 1
    return "".join([chr(min(_FIRST + n, _LAST)) for n in counts])


def steps(path: str, used: int) -> Iterator[tuple[str, int]]:
    """Paths that a search may take beside `path`, and the budget used then: 0 nothing, 1 one letter more, 2 also one less.

    The first difference is a surplus: a pair of words is found from one of its ends only.
    """
    yield path, used
    if used == 0:
        for i, c in enumerate(path):
            more = path[:i] + chr(ord(c) + 1)
            for rest, then in steps(path[i + 1:], 1):
                yield more + rest, then
    elif used == 1:
        for i, c in enumerate(path):
            if ord(c) > _FIRST:
                yield path[:i] + chr(ord(c) - 1) + path[i + 1:], 2


#: By the budget used: how a member's count may differ from the visitor's, and the budget used then.
MOVES = {0: ((0, 0), (1, 1)), 1: ((0, 1), (-1, 2)), 2: ((0, 2),)}


def near(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced between two different words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]
    return len(a) < len(b)


class Node:
    """Words below a node of the trie; children are made when the search goes there."""

    __slots__ = ("words", "children")

    def __init__(self, words: list):
        self.words, self.children = words, None

    def below(self, level: int) -> dict[int, "Node"]:
        if self.children is None:
            parts: dict[int, list] = {}
            for w in self.words:
                parts.setdefault(ord(w[0][level]), []).append(w)
            self.children = {c: Node(p) for c, p in parts.items()}
        return self.children


def search(members: Node, visitors: Node, level: int, used: int, out: list) -> None:
    """Append (visitor, member) for all near words; both hold tuples (path, word, ...). Members have to come after their visitors by path and word."""
    if level == LEVELS or len(members.words) * len(visitors.words) <= FEW:
        if len(members.words) * len(visitors.words) <= FEW * FEW:
            out.extend((v, m) for v in visitors.words for m in members.words if m[:2] > v[:2] and near(v[1], m[1]))
        else:
            out.extend((v, m) for v, m in _halves(members.words, visitors.words) if m[:2] > v[:2])
        return
    here = members.below(level)
    for count, part in visitors.below(level).items():
        for change, then in MOVES[used]:
            if found := here.get(count + change):
                search(found, part, level + 1, then, out)


def _halves(members: list, visitors: list) -> Iterator[tuple]:
    """Near pairs of a crowded leaf: words one edit apart share their first or their last half, as cut in the shorter word."""
    table: dict[tuple, list] = {}
    for m in members:
        for size in {len(m[1]), len(m[1]) - 1}:
            table.setdefault((size, len(m[1]), 0, m[1][:size // 2]), []).append(m)
            table.setdefault((size, len(m[1]), 1, m[1][len(m[1]) - (size - size // 2):]), []).append(m)
    for v in visitors:
        size = len(v[1])
        for long in (size, size + 1):
            first, last = ((size, long, 0, v[1][:size // 2]), (size, long, 1, v[1][size // 2:]))
            found = {id(m): m for key in (first, last) for m in table.get(key, ()) if near(v[1], m[1])}
            yield from ((v, m) for m in found.values())


def near_words(words: DataFrame, bound: int = BOUND) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of near words among the distinct `words` (word, n).

    The upper levels of the trie are walked by joins, STEP levels at a time: every word visits the nodes that lie within the budget. A
    node with at most `bound` words is a subtree that one task searches to its leaves; visitors of a much visited
    subtree are dealt to several tasks, and so are the words of a full path shared by more than `bound`.
    """
    path = F.arrow_udf(lambda column: pa.array([vector(w) for w in column.to_pylist()], pa.string()), "string")
    members = staged(small_batches(words).select("word", "n", path("word").alias("path")), "trie")
    frontier = members.select("*", F.lit("").alias("node"), F.lit(0).alias("used"))
    schema = "word string, n long, path string, node string, used int"
    arrived, placed = [], []
    for depth in range(STEP, LEVELS + 1, STEP):
        def down(batches: Iterator[pa.RecordBatch], at: int = depth - STEP, to: int = depth) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nexts = [[(node + step, then) for step, then in steps(path[at:to], used)]
                         for path, node, used in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
                rows = pa.array([i for i, found in enumerate(nexts) for _ in found], pa.int64())
                yield pa.record_batch([*(batch.column(i).take(rows) for i in range(3)),
                                       pa.array([x[0] for found in nexts for x in found], pa.string()),
                                       pa.array([x[1] for found in nexts for x in found], pa.int32())], ["word", "n", "path", "node", "used"])

        here = members.withColumn("node", F.substring("path", 1, depth))
        nodes = here.groupBy("node").agg(F.count("*").alias("size"))
        nodes = staged(nodes.withColumn("open", (F.col("size") > bound) & F.lit(depth < LEVELS)), "nodes")
        visits = staged(keyed_join(frontier.mapInArrow(down, schema), nodes, "node"), "visits")
        homes = staged(keyed_join(here, nodes, "node"), "homes")
        arrived.append(visits.filter("not open").drop("open"))
        placed.append(homes.filter("not open").drop("open"))
        members = homes.filter("open").select("word", "n", "path")
        frontier = visits.filter("open").select("word", "n", "path", "node", "used")
        if not nodes.filter("open").head(1):
            break
    visitors, members = arrived[0], placed[0]
    for more, others in zip(arrived[1:], placed[1:]):
        visitors, members = visitors.union(more), members.union(others)
    shape = staged(visitors.groupBy("node").agg(
        F.ceil(F.count("*") / (2 * bound)).cast("int").alias("slices"), F.ceil(F.max("size") / bound).cast("int").alias("blocks")), "shape")
    dealt = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    visitors = keyed_join(visitors, shape, "node").select(
        "node", (dealt % F.col("slices")).cast("int").alias("slice"), numbers("blocks").alias("block"), "word", "n", "path", "used")
    members = keyed_join(members, shape, "node").select(
        "node", numbers("slices").alias("slice"), (dealt % F.col("blocks")).cast("int").alias("block"), "word", "n", "path", F.lit(-1).alias("used"))

    def searched(group: pa.Table) -> pa.Table:
        by_used: dict[int, list] = {-1: [], 0: [], 1: [], 2: []}
        for used, *word in zip(*(group.column(c).to_pylist() for c in ("used", "path", "word", "n"))):
            by_used[used].append(tuple(word))
        out: list = []
        depth = len(group.column("node")[0].as_py())
        tree = Node(by_used.pop(-1))
        for used, visiting in by_used.items():
            if visiting and tree.words:
                search(tree, Node(visiting), depth, used, out)
        both = [x for a, b in out for x in ((*a[1:], *b[1:]), (*b[1:], *a[1:]))]
        columns = zip(*both) if both else [()] * 4
        return pa.table({c: pa.array(v, t) for c, v, t in zip(
            ("word", "n", "near", "near_n"), columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))})

    return visitors.union(members).groupBy("node", "slice", "block").applyInArrow(searched, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form), where forms of forms are followed to the last: pointers double their reach in every round."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(keyed_join(now, ahead, "root", "left"), "roots")
        done = not after.filter("further is not null").head(1)
        drop_staged(now)
        now = after.select("word", F.coalesce("further", "root").alias("root"))
        if done:
            return now


def spelling_variants(docs: DataFrame, least_letters: int = 5, least: int = 3, id_column: str = "doc_id", text_column: str = "text",
                      bound: int = BOUND) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    Words are near if one inserted, deleted or replaced code point parts them. The form of a word is its near word of largest n (ties: the
    smallest in code-point order) if that is at least twice its own n, else null; root follows the forms to the last. Null and empty texts
    have no words, repeated rows count each time, an empty table gives no rows, other columns are not read. Words of any length count.
    """
    words = staged(word_counts(docs, least_letters, least, id_column, text_column), "words")
    best = near_words(words, bound).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    known = staged(keyed_join(words, best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), -F.col("best.minus")).alias("form_n")), "forms")
    last = roots(known.filter("form is not null").select("word", "form"))
    return keyed_join(known, last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
