"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n long, node string, root int"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA).repartition(3)


def distance_one(a, b):
    """Every edit of `a`, tried out."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least_letters=5, least=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_letters and c >= least}
    close = {w: set() for w in n}
    shapes = {}
    for w in n:  # words that agree after one deletion each, or that one deletion turns into another
        for s in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            shapes.setdefault(s, []).append(w)
    for ws in shapes.values():
        for a in ws:
            close[a] |= {b for b in ws if distance_one(a, b)}
    form = {}
    for w, ws in close.items():
        if ws:
            best = min(ws, key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return sorted(out)


def test_plain_finds_all_pairs():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(5, 8))) for _ in range(120)})
    rows = [(i, w) for i, w in enumerate(words) for _ in range(3)]
    kept = [w for w, *_ in plain(rows)]
    assert sum(x[4] for x in plain(rows)) == sum(distance_one(a, b) for a in kept for b in kept)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = plain(rows)
    assert got(QUERIES["op11_spelling"](spark, folder)) == want
    assert sum(w[1] is not None for w in want) > 100 and any(w[1] != w[2] for w in want if w[1])


@pytest.mark.parametrize("bound, few, alphabet", [(8192, 48, "etaé"), (4, 0, "etaé"), (3, 2, "éàüñxyz"), (2, 48, "zq")])
def test_any_shape_of_the_search(spark, bound, few, alphabet, monkeypatch):
    monkeypatch.setattr(spelling, "FEW", few)
    rng = random.Random(bound)
    rows = [(i, " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 9))) for _ in range(60))) for i in range(30)]
    assert got(spelling.spelling_variants(frame(spark, rows), 5, 2, bound=bound)) == plain(rows, 5, 2)


def test_search_and_halves_in_one_task(monkeypatch):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(700)})
    tree = [(spelling.vector(w), w) for w in words]
    want = sorted((a, b) for a in words for b in words if a < b and distance_one(a, b))
    for few in (0, 1, 48, 10 ** 9):
        monkeypatch.setattr(spelling, "FEW", few)
        out = []
        spelling.search(spelling.Node(tree), spelling.Node(tree), 0, 0, out)
        assert sorted(tuple(sorted((a[1], b[1]))) for a, b in out) == want
    found = [(v[1], m[1]) for v, m in spelling._halves(tree, tree)]
    assert sorted(p for p in found if len(p[0]) <= len(p[1])) == sorted(
        (a, b) for a in words for b in words if distance_one(a, b) and len(a) <= len(b))


def test_edges(spark):
    long = "a" * 70_000
    rows = [(1, None), (2, ""), (None, "colour colour colour colour"), (3, "color, COLOR color\x00color"), (3, "color"), (3, "color"),
            (4, "colours colours colours ÀÉÎÕÜ ÀÉÎÕÜ àÉÎÕÜ ÀÉÎÕÜ"), (5, f"{long} {long} {long}"), (6, f"{long}a " * 3), (7, "abcd abcd abcd")]
    want = plain(rows)
    assert got(spelling.spelling_variants(frame(spark, rows))) == want
    words = {w[0]: w for w in want}
    assert words["colour"][1] is None and words["ÀÉÎÕÜ"][3] == 3 and words[long][4] == 1 and "abcd" not in words


def test_ties_and_chains(spark):
    rows = [(1, "trees " * 4 + "treed " * 4 + "treep " * 2 + "treeps " + "x" * 5)]
    out = {r.word: r for r in spelling.spelling_variants(frame(spark, rows), 5, 1).collect()}
    assert out["treep"].form == "treed" and out["treeps"].form == "trees" and out["treeps"].root == "trees"
    chain = [(1, " ".join(("abcde" + "xyzuvw"[:i] + " ") * 2 ** (8 - i) for i in range(7)))]
    assert got(spelling.spelling_variants(frame(spark, chain), 5, 1)) == plain(chain, 5, 1)
    assert {r.root for r in spelling.spelling_variants(frame(spark, chain), 5, 1).collect()} >= {"abcde"}


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, "one two")]):
        empty = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)
        assert got(spelling.spelling_variants(empty)) == []
