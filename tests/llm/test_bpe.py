"""Merge replay against a step-by-step encoder, the tiktoken library and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES, RANKS

SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "\n\n \n", "naïve café — 東京 🚀🚀", "<|endoftext|> ### Assistant:", "x" * 30_000, "ab" * 20_000, "1234567890" * 50,
       "\u0000�​", "don't WE'LL i'm", "  two  spaces ", "=" * 999 + "!"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def stepwise(word, ranks):
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return tuple(ranks[p] for p in parts)
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(40))
def test_replay_with_any_order_of_ranks(seed):
    rng = random.Random(seed)
    tokens = {bytes([c]) for c in b"abcd"}
    while len(tokens) < 60:
        tokens.add(b"".join(rng.sample(sorted(tokens), 2))[:6])
    order = sorted(tokens)
    rng.shuffle(order)
    ranks = {t: i for i, t in enumerate(order)}
    words = ["".join(rng.choices("abcd", k=rng.randrange(1, 40))).encode() for _ in range(300)]
    got = [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in bpe.replay(words, bpe.Merges(ranks))]
    assert got == [stepwise(w, ranks) for w in words]


def test_encode_and_decode(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None])] + [(None, "no id", "x"), (0, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(2)
    out = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    got = out.select("doc_id", "ids", bpe.decode(out.ids, RANKS).alias("raw")).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.raw)) for r in got) == want
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
