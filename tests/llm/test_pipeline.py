"""The pipeline stage by stage against brute force on each stage's own input."""

import hashlib

import pytest
import tiktoken
import public_tokenizers

import corpus_pipeline as pipeline
from test_decontaminate import brute as contained
from test_dedup import brute as components, plain_fingerprint
from tidemark.llm import bpe
from tidemark.llm.common import staged
from tidemark.llm.queries import RANKS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents, and what each stage made of its predecessor's."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], FOLDER), "test"))
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "benchmark decontamination", "byte-level bpe"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.count() > 0
        assert df.select("doc_id").subtract(stages[0].select("doc_id")).count() == 0


def test_quality(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = texts(stages[0]), texts(stages[1])
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.95 * len(good)
    assert sum(i in after for i in bad) <= 0.4 * len(bad)


def test_exact(stages):
    before, after = texts(stages[1]), texts(stages[2])
    largest = {}
    for i, t in before.items():
        largest[t] = max(i, largest.get(t, i))
    assert after == {i: t for t, i in largest.items()}


def test_near(stages):
    before, after = texts(stages[2]), texts(stages[3])
    label = components({i: plain_fingerprint(t) for i, t in before.items()}, 2)
    assert set(after) == set(label.values())


def test_decontamination(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    assert set(after) == {i for i, t in before.items() if not contained(t, items)}


def test_tokens_and_run(spark, stages):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    before = texts(stages[4])
    want = {i: (library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in before.items()}
    for rows in (stages[5].collect(), pipeline.run(spark, FOLDER).collect()):
        assert {r.doc_id: (r.ids, r.decoded_sha256) for r in rows} == want
        assert all(r.n_tokens == len(r.ids) for r in rows)
