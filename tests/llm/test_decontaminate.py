"""Greedy string tiling against a naive version; whole documents against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def naive(item, text, least):
    """Tiles by trying every pair of places for the longest unmarked match, again and again."""
    marked_item, marked_text, out = set(), set(), []
    while True:
        best = None
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n]
                       and p + n not in marked_item and t + n not in marked_text):
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, p, t)
        if best is None:
            return out
        n, p, t = best
        marked_item.update(range(p, p + n))
        marked_text.update(range(t, t + n))
        out.append((p, t, n))


@pytest.mark.parametrize("seed", range(30))
def test_tiles(seed):
    rng = random.Random(seed)
    alphabet = range(rng.choice([2, 3, 6]))
    item = [rng.choice(alphabet) for _ in range(rng.randrange(25))]
    text = [rng.choice(alphabet) for _ in range(rng.randrange(30))]
    for _ in range(2):
        at = rng.randrange(len(text) + 1)
        text[at:at] = item[rng.randrange(len(item) + 1):][:rng.randrange(12)]
    least = rng.choice([2, 3, 5])
    assert d.tiles(np.array(item, np.int64), np.array(text, np.int64), least) == naive(item, text, least)


def covered(item, text, least):
    """Words under tiles, the longest run found by dynamic programming in each step."""
    item, text, total = np.array(item, object), np.array(text, object), 0
    while True:
        run, best = np.zeros(len(text) + 1, int), (0, 0, 0)
        for p in range(len(item)):
            run = np.concatenate([[0], np.where(text == item[p], run[:-1] + 1, 0)])
            t = int(run.argmax())
            if run[t] > best[0]:
                best = (int(run[t]), p + 1 - int(run[t]), t - int(run[t]))
        n, p, t = best
        if n < least:
            return total
        item[p:p + n], text[t:t + n], total = "<item>", "<text>", total + n


def brute(text, items, least=5, coverage=0.8):
    own = d.words(text or "")
    out = {}
    for i, t in items:
        w = d.words(t)
        if len(w) >= least:
            shared = {tuple(w[k:k + least]) for k in range(len(w))} & {tuple(own[k:k + least]) for k in range(len(own))}
            if shared:
                n = covered(w, own, least)
                if n >= coverage * len(w):
                    out[i] = n / len(w)
    return out


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op7_decontaminate"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert len(got) == len(docs)
    for r in docs:
        want = brute(r.text, items)
        assert got[r.doc_id].n_items == len(want) and got[r.doc_id].contaminated == bool(want)
        if want:
            assert got[r.doc_id].coverage == max(want.values())
    assert sum(r.contaminated for r in got.values()) >= 10


ITEM = " ".join(f"w{i}" for i in range(30))
PARTS = ITEM.split()


@pytest.mark.parametrize("text, found", [
    (ITEM, 1.0), (ITEM.upper().replace(" ", " -- "), 1.0), (" ".join(PARTS[20:] + ["x"] + PARTS[:10] + ["y"] + PARTS[10:20]), 1.0),
    (" ".join(PARTS[:24]), 0.8), (" ".join(PARTS[:23]), None), (" ".join(w for p in range(0, 30, 4) for w in PARTS[p:p + 4] + ["x"]), None),
    (" ".join(PARTS[:8] * 20), None), (None, None), ("", None), ("w1 w2", None), ("pad " * 50_000 + ITEM + " pad" * 50_000, 1.0)])
def test_cases(text, found):
    hits = d.Index([(1, ITEM), (2, "a b c"), (3, "")], 5, 0.8).search(text or "")
    assert [h["matched"] / h["words"] for h in hits] == ([found] if found else [])


def test_blocks_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean text of no item at all", "b"), (None, ITEM, "c"), (3, None, "d"), (1, ITEM, "a")],
                                 "doc_id long, text string, hits string")
    more = " ".join(f"v{i}" for i in range(12))
    benchmark = spark.createDataFrame([(7, ITEM), (7, ITEM), (9, more), (None, ITEM + " w30"), (4, None)], "item_id long, text string")
    for size in (150, 1 << 20):
        plain = sorted(map(repr, [tuple(r) for r in d.contamination(docs, benchmark, block_bytes=size).collect()]))
        assert plain == sorted(map(repr, [(1, True, 2, 7, 1.0)] * 2 + [(None, True, 2, 7, 1.0), (2, False, 0, None, None), (3, False, 0, None, None)]))
        kept = d.drop_contaminated(docs, benchmark, block_bytes=size)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    none = benchmark.limit(0)
    assert d.drop_contaminated(docs, none).count() == 5
    assert d.contamination(docs.limit(0), benchmark).count() == 0
    assert d.contamination(docs, none).filter(F.col("contaminated")).count() == 0


def test_query_returns_every_item(spark, folder):
    more, where = " ".join(f"v{i}" for i in range(12)), folder("two-items")
    spark.createDataFrame([(1, f"{more} between {ITEM}"), (2, "clean")], "doc_id long, text string").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(9, ITEM), (4, more)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_decontaminate"](spark, where).collect()}
    assert [tuple(h) for h in got[1].hits] == [(4, 12, 12), (9, 30, 30)] and got[1].item_id == 4
    assert got[2].hits == [] and not got[2].contaminated


def test_repeated_words_at_length():
    """20,000 equal words against themselves, and long periodic sequences, in little memory."""
    import time
    import tracemalloc
    same = np.zeros(20_000, np.int64)
    period, other = np.tile(np.arange(7), 2000), np.tile(np.arange(11) % 7, 1500)
    for item, text, want in ((same, same, [(0, 0, 20_000)]), (period, period, [(0, 0, 14_000)]), (period, other, None), (same[:5000], period % 2, None)):
        tracemalloc.start()
        began, found = time.time(), d.tiles(item, text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert want is None or found == want
        assert peak < 100e6 and time.time() - began < 60
        assert all((item[p:p + n] == text[t:t + n]).all() for p, t, n in found)


def test_equal_hashes_are_compared(monkeypatch):
    """With windows that all hash alike the tiles are the same."""
    rng = random.Random(5)
    item, text = (np.array([rng.randrange(3) for _ in range(40)], np.int64) for _ in range(2))
    want = d.tiles(item, text, 3)
    monkeypatch.setattr(d.Windows, "free", lambda self, free, size, real=d.Windows.free: (lambda r: (r[0], r[1] * np.uint64(0)))(real(self, free, size)))
    assert d.tiles(item, text, 3) == want


def test_item_ids_of_any_type(spark):
    benchmark = spark.createDataFrame([("gsm8k/1", "one two three four five six"), ("gsm8k/0", "one two three four five six"), (None, "a b c d e f g"),
                                       ("", "seven eight nine ten eleven")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "say one two three four five six now"), (2, "a b c d e f g"), (3, "x"), (4, "seven eight nine ten eleven")], "doc_id long, text string")
    out = {r.doc_id: r for r in d.contamination(docs, benchmark, full=True).collect()}
    assert (out[1].item_id, out[1].n_items, [h.item_id for h in out[1].hits]) == ("gsm8k/0", 2, ["gsm8k/0", "gsm8k/1"])
    assert out[2].contaminated and out[2].item_id is None and not out[3].contaminated and out[4].item_id == ""
    assert [r.doc_id for r in d.drop_contaminated(docs, benchmark).collect()] == [3]
