"""Phrase collocations against brute force and SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from oracle import compare, connect
from tidemark.llm import collocation
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, lang string, text string, a long, key long, phrase string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def frame(spark, rows):
    return spark.createDataFrame([(i, lang, t, 1, 2, "x") for i, lang, t in rows], SCHEMA).repartition(3)


def plain(rows, support=10, longest=3, inside=50, top=2000):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    out = {}
    for (lang, p), a in candidates.items():
        if any(g == lang and len(q) > len(p) and 100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (g, q), b in candidates.items()):
            continue
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, x, y, n[lang], -score) for lang, found in out.items()
                  for rank, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1))


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    assert compare(spark, connect(folder), "op12", QUERIES["op12_collocation"], ORACLES["op12_collocation"], folder) is None


def texts(seed, many, words="the a of New York city é Öl x-1"):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 2, i]), rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(words.split()) + rng.choice([" ", " ", "\t ", "  ", ". ", "\n", "\r\n", " , "]) for _ in range(rng.randrange(60)))) for i in range(many)]


@pytest.mark.parametrize("support, longest, shards, top, slice_bytes", [
    (10, 3, 3, 2000, 2_000_000), (7, 4, 5, 3, 300), (1, 2, 3, 2000, 50), (10, 3, 1, 5, 2_000_000), (5, 3, 9, 2000, 40)])
def test_against_brute_force(spark, support, longest, shards, top, slice_bytes, monkeypatch):
    monkeypatch.setattr(collocation, "SLICE", slice_bytes)
    rows = texts(support, 80)
    assert got(collocation.collocations(frame(spark, rows), support, longest, 50, top, shards)) == plain(rows, support, longest, 50, top)


def test_full_filters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocation, "MOST_BITS", 64)
    monkeypatch.setattr(collocation, "HELD", 10)
    rows = texts(4, 60)
    assert got(collocation.collocations(frame(spark, rows), 5)) == plain(rows, 5)


@pytest.mark.parametrize("shards", [1, 2, 4, 10, 12])
def test_candidates_at_the_least_support(spark, shards):
    """Phrases that occur `support` times exactly, however their occurrences lie."""
    rng = random.Random(shards)
    rows = [(rng.randrange(1000), "en", f"{w} {w}x {w}y") for w in "abcdefghij" for _ in range(10)] + [(i, "en", "k l") for i in range(9)]
    out = got(collocation.collocations(frame(spark, rows), inside=101, shards=shards))
    assert out == plain(rows, inside=101) and len(out) == 30


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(collocation, "mix", lambda x: x * np.uint64(0))
    words = collocation.Words([b"a b a", b"b c c", b"a"])
    ids = words.ids(np.array([1, 2, 1], np.uint64))
    names = [(t, w) for t, w in zip([1, 1, 1, 2, 2, 2, 1], "a b a b c c a".split())]
    assert len(set(zip(ids.tolist(), names))) == len(set(ids.tolist())) == len(set(names)) == 4


def test_edges(spark):
    rows = [(1, None, None), (2, "en", ""), (3, "en", "...,,\n"), (4, "en", "One Two. " * 12), (4, "en", "One Two. " * 12), (5, None, "one two " * 30_000),
            (6, "fr", "\x00  a b c " * 15), (7, "de", "ÄB äb " * 10), (8, "xx", "only words here")]
    out = got(collocation.collocations(frame(spark, rows)))
    assert out == plain(rows)
    assert ("en", 1, "one two", 24, 24, 24, 48, 1000000) in out


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(3 * 10 ** 12, 3 * 10 ** 12 + 1, 4 * 10 ** 12)], "a long, l long, r long")
    a, x, y = rows.first()
    score = rows.select(F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0)))"
                               " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))").alias("s")).first().s
    assert score == 1000000 * a * a // (x * y)


def test_empty(spark):
    assert got(collocation.collocations(frame(spark, [(1, "x", "y")]).filter("doc_id > 1"))) == []
    assert got(collocation.collocations(frame(spark, [(1, None, None)]))) == []
