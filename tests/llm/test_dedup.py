"""Exact and SimHash deduplication against brute force."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from oracle import compare, connect
from tidemark.llm import exact_dedup, simhash
from tidemark.llm.common import connected_components
from tidemark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, hash string, fp long, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA).repartition(3)


def test_exact_query(spark):
    assert compare(spark, connect(SMALL), "op5", QUERIES["op5_exact_dedup"], ORACLES["op5_exact_dedup"], SMALL) is None


@pytest.mark.parametrize("content_hash", [exact_dedup.md5_128, lambda t: F.lit(b"one")], ids=["md5", "all hashes collide"])
def test_exact_cases(spark, content_hash):
    rows = [(3, "a"), (1, "a"), (None, "a"), (2, None), (5, ""), (9, "b"), (9, "b"), (None, "c"), (4, "é" * 50_000)]
    got = {}
    for r in exact_dedup.exact_duplicates(frame(spark, rows), content_hash=content_hash).collect():
        got.setdefault((r.doc_id, r.text_sha256), []).append((r.keep_id, r.group_size, r.kept))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {
        (3, sha("a")): [(1, 3, False)], (1, sha("a")): [(1, 3, True)], (None, sha("a")): [(1, 3, False)],
        (2, sha("")): [(2, 2, True)], (5, sha("")): [(2, 2, False)], (9, sha("b")): [(9, 2, True)] * 2,
        (None, sha("c")): [(None, 1, True)], (4, sha("é" * 50_000)): [(4, 1, True)]}


def test_exact_drop_keeps_columns_and_one_of_repeats(spark):
    rows = [(3, "a"), (1, "a"), (9, "b"), (9, "b"), (2, None), (5, "")]
    out = exact_dedup.drop_exact_duplicates(frame(spark, rows), keep="largest")
    assert out.columns == ["doc_id", "text", "hash", "fp", "kept"]
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(3, "a"), (5, ""), (9, "b")]


def test_exact_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def plain_fingerprint(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [words[i:i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, distance):
    """prints: id -> fingerprint; id -> smallest reachable id."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_simhash_cases(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(300)]
    docs = [(i, " ".join(base[:200] + [str(i)] * (i % 4))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "\x0b  "), (103, "ONE two"), (104, "one  TWO"), (105, "É three"), (106, "x " * 40_000)]
    docs += [(None, "one two")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, docs)).collect()}
    prints = {i: plain_fingerprint(t or "") for i, t in docs if i is not None}
    label = brute(prints, 2)
    assert got.pop(None) == got[103]
    assert got == {i: (f"{prints[i]:016x}", label[i]) for i in prints}
    assert got[100][1] == got[101][1] == 100


@pytest.mark.parametrize("distance, bucket", [(1, 1), (1, 4), (1, 64), (2, 1), (2, 4), (2, 64), (0, 64), (3, 4), (3, 64), (4, 8), (4, 64), (6, 10_000)])
def test_links_do_not_depend_on_the_bucket_bound(spark, distance, bucket):
    rng = random.Random(distance)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(40):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
            prints.add(c ^ (rng.getrandbits(5) << 30))
    ids = {simhash._signed(p): p for p in prints}
    links = simhash.near_links(spark.createDataFrame([(i,) for i in ids], "fp long"), distance, bucket)
    pairs = links.collect()
    assert all(0 < bin(ids[r.a] ^ ids[r.b]).count("1") <= distance for r in pairs)
    got = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    want = brute(ids, distance)
    assert {i: got.get(i, i) for i in ids} == want


def test_components_of_a_long_chain(spark):
    links = spark.range(400).selectExpr("id * 7 % 401 as a", "(id + 1) * 7 % 401 as b")
    assert {r.component for r in connected_components(links, "a", "b").collect()} == {0}
    assert connected_components(links, "a", "b").count() == 401


def test_simhash_drop(spark):
    docs = [(5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (8, "w x y z k")]
    out = simhash.drop_near_duplicates(frame(spark, docs))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "8", "None"]
    assert out.columns == ["doc_id", "text", "hash", "fp", "kept"]


def test_simhash_drop_tells_rows_of_one_id_apart(spark):
    docs = [(1, "a b c d"), (2, "a b c d"), (2, "w x y z k"), (2, "w x y z k"), (7, None), (7, "a b c d"), (7, "p q r s t u"), (9, "p q r s t u"), (None, "w x y z k")]
    out = sorted(((r.doc_id or 0, r.text) for r in simhash.drop_near_duplicates(frame(spark, docs)).collect()), key=str)
    assert out == [(0, "w x y z k"), (1, "a b c d"), (2, "w x y z k"), (7, "p q r s t u"), (7, None)]
    several = spark.createDataFrame([(1, "x y z v", {"k": 1}), (1, "x y z v", {"k": 2}), (2, "x y z v", None)], "doc_id long, text string, m map<string,int>")
    assert simhash.drop_near_duplicates(several).count() == 1


def test_segments_cannot_all_be_passed():
    for distance in range(1, 12):
        found = simhash.segments(distance)
        assert sum(w for _, w, _ in found) == 64 and sum(r + 1 for _, _, r in found) == distance + 1
        assert all(r in (0, 1) for _, _, r in found)
