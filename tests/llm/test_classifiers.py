"""Quality and toxicity: held-out accuracy, gradients of the learners by example, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, least", [("op9_quality", "quality", 0.93), ("op6_toxicity", "toxic", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    scored = QUERIES[name](spark, FOLDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    seen = scored.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(seen) > 500
    for value in (0, 1):
        rows = [r for r in seen if r[label] == value]
        right = sum(r.predicted == value for r in rows) / len(rows)
        assert right >= least - 0.13, (label, value, right)
    assert sum(r.predicted == r[label] for r in seen) / len(seen) >= least
    assert all(0 <= r.score <= 1 for r in seen)


@pytest.mark.parametrize("name", ["op9_quality", "op6_toxicity"])
def test_every_document_once(spark, name):
    folder = "/root/testdata/sf0.001"
    out = QUERIES[name](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert out.count() == docs.count()
    assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0


def pair_rows(n):
    """Toxic only where two words meet; either alone is harmless: no sum of weights can say so."""
    rng = random.Random(3)
    out = []
    for i in range(n):
        a, b = rng.random() < .5, rng.random() < .5
        text = ["f" + str(rng.randrange(30)) for _ in range(6)] + ["insult"] * a + ["group"] * b + ["kind"] * (not a) + ["chair"] * (not b)
        out.append((" ".join(text), int(a == b)))
    return out


def test_factors_learn_pairs():
    texts = pair_rows(3000)
    machine = toxicity.train([(toxicity.terms(t), y) for t, y in texts[:2500]], epochs=60)
    scorer = toxicity.Scorer(machine)
    assert sum((scorer.probability(t) > 0.5) == y for t, y in texts[2500:]) >= 480


def rare_pair_rows(n, vocabulary=40_000, length=120):
    """Two words that say nothing alone, among many words of a large vocabulary."""
    rng = random.Random(11)
    out = []
    for _ in range(n):
        a, b = rng.random() < .5, rng.random() < .5
        text = [f"w{rng.randrange(vocabulary)}" for _ in range(length)] + ["insult"] * a + ["group"] * b
        out.append((toxicity.terms(" ".join(text)), int(a == b)))
    return out


def test_pairs_are_learned_in_a_large_vocabulary():
    rows = rare_pair_rows(3600)
    right = {}
    for name, penalties in (("pairs", (0.5, 2.0)), ("additive", (0.5, 1e9))):
        m = toxicity.train(rows[:3000], penalties=penalties)
        right[name] = sum((toxicity.logit(m.places(f), m) > 0) == y for f, y in rows[3000:]) / 600
    assert right["pairs"] >= 0.8 and right["additive"] < 0.6, right


def test_every_bucket_of_the_rows_takes_part():
    """No bucket is left out before training: with penalties of zero all of them keep a weight."""
    rows = rare_pair_rows(200)
    m = toxicity.train(rows, penalties=(0.0, 0.0), epochs=2, settle=1)
    assert set(m.buckets) == {b for f, _ in rows for b in f.tolist()} and (m.weights != 0).mean() > 0.9


def test_training_edges():
    none = np.zeros(0, np.int64)
    assert len(toxicity.train([]).buckets) == 0 and len(toxicity.train([(none, 1)]).buckets) == 0
    m = toxicity.train([(none, 1), (none, 0), (np.array([3, 9]), 1), (np.array([4]), 0)] * 30)
    assert all(0 < toxicity.logit(m.places(np.array(p)), m) for p in ([3, 9],)) and toxicity.logit(m.places(np.array([4])), m) < 0
    assert np.isfinite(toxicity.logit(m.places(np.array([77])), m))


def test_logit_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = toxicity.Machine(.3, np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)))
    at = np.array([1, 4, 7, 8])
    want = m.bias + m.weights[at].sum() + sum(m.vectors[i] @ m.vectors[j] for k, i in enumerate(at) for j in at[k + 1:])
    assert toxicity.logit(at, m) == pytest.approx(want)


def test_block_maxima_equal_a_plain_convolution():
    rng = np.random.default_rng(1)
    net = quality.train([(b"a", 1)])
    net.bias[:] = rng.normal(size=quality.FILTERS)
    raw = bytes(rng.integers(0, 256, 700, np.uint8))
    padded = raw + bytes(3 * quality.BLOCK + quality.WIDTH - len(raw))
    want = np.full((3, quality.FILTERS), -np.inf)
    for p in range(0, 3 * quality.BLOCK, quality.STRIDE):
        answer = sum(net.filters[k][padded[p + k]] for k in range(quality.WIDTH)) + net.bias
        want[p // quality.BLOCK] = np.maximum(want[p // quality.BLOCK], answer)
    assert np.allclose(quality.block_maxima(raw, net.pairs(), net.bias), want, atol=1e-4)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module):
    schema = "doc_id long, text string, score double"
    rows = [(1, "good words here", 0.0), (2, None, 0.0), (3, "", 0.0), (None, "no id", 0.0), (4, "x" * 300_000, 0.0), (1, "again", 0.0)]
    docs = spark.createDataFrame(rows, schema)
    for labels in ([], [(1, 1), (1, 0), (2, 0), (3, None), (None, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        model = module.fit(docs, table, lambda i: F.lit(True), label="quality")
        got = docs.select("doc_id", module.score(F.col("text"), model).alias("p")).collect()
        assert len(got) == len(rows) and all(0 <= r.p <= 1 for r in got)
    assert docs.limit(0).select(module.score(F.col("text"), model)).count() == 0


def test_one_label_only_gives_the_prior():
    assert toxicity.Scorer(toxicity.train([(toxicity.terms("a b"), 0)] * 8)).probability("a") == pytest.approx(0.1)
    net = quality.train([(b"abc", 1)] * 8)
    assert quality.probability(b"anything", net, net.pairs()) == pytest.approx(0.9, abs=1e-5)
