"""Licence scan against SQL and a plain Python version."""

import math
import re

import pytest

from oracle import compare, connect
from tidemark.llm import licenses
from tidemark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, found string"


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    assert compare(spark, connect(folder), "op10", QUERIES["op10_licenses"], ORACLES["op10_licenses"], folder) is None


def plain(text, templates, threshold):
    out = []
    for number, passage in enumerate([text, *text.split("\n")]):
        words = [w for w in re.split("[^a-z0-9]+", passage.lower()) if w]
        own = set(zip(words, words[1:])) or {(w,) for w in words}
        best = None
        for name, body in templates:
            other = [w for w in re.split("[^a-z0-9]+", body.lower()) if w]
            other = set(zip(other, other[1:])) or {(w,) for w in other}
            dice = 2 * len(own & other) / max(1, len(own) + len(other))
            if dice >= threshold and (best is None or dice > best[2]):
                best = (number, name, dice)
        if best:
            out.append(best)
    return out


MIT = licenses.TEMPLATES[2][1]
TEXTS = [None, "", "\n", "Released under the MIT License.", "released UNDER the mit-license\nRELEASED under MIT License", "MIT", "under the MIT License",
         MIT, MIT.replace("Software", "Program", 3), "Copyright 2024 A. Nyone\n\n" + MIT, " ".join(MIT.split()) + "\nwords " * 3, "x " * 60_000,
         ("no licence here " * 9 + "\n") * 500 + "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "É Licensed under\tthe Apache License, Version 2.0 ü"]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_cases(spark, threshold):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "x"), (3, TEXTS[3], "x")]
    got = licenses.licences(spark.createDataFrame(rows, SCHEMA).repartition(3), threshold=threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[3] if r.doc_id is None else TEXTS[r.doc_id]
        want = plain(text or "", licenses.TEMPLATES, threshold)
        assert [(f.passage, f.licence, pytest.approx(f.dice)) for f in r.found] == want, r.doc_id


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_marks_are_necessary(threshold):
    for _, text in licenses.TEMPLATES:
        own = licenses.template_bigrams(text)
        free = [b for b in own if not set(b.split()) & licenses.marks(own, threshold)]
        assert len(free) < math.ceil(threshold / (2 - threshold) * len(own) - 1e-9)


def test_own_templates_and_empty(spark):
    docs = spark.createDataFrame([(1, "word", "x"), (2, "two words", "x")], SCHEMA)
    got = {r.doc_id: [tuple(f) for f in r.found] for r in licenses.licences(docs, [("one", "WORD"), ("none", "!"), ("two", "two words")]).collect()}
    assert got == {1: [(0, "one", 1.0), (1, "one", 1.0)], 2: [(0, "two", 1.0), (1, "two", 1.0)]}
    assert {len(r.found) for r in licenses.licences(docs, []).collect()} == {0}
    assert licenses.licences(docs.limit(0)).count() == 0


def test_query_returns_every_passage(spark, folder):
    where = folder("two-licences")
    text = "Released under the MIT License.\nLicensed under CC BY-NC 4.0."
    spark.createDataFrame([(1, text, ""), (2, "none", "")], SCHEMA).write.parquet(f"{where}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op10_licenses_found"](spark, where).collect()}
    assert [(f.passage, f.licence, f.dice) for f in got[1].found] == [(1, "MIT", 1.0), (2, "CC-BY-NC-4.0", 1.0)]
    assert (got[1].n_passages, got[1].licence, got[1].passage) == (2, "MIT", 1) and got[2].found == []


def plain_runs(text, templates, threshold):
    """Every run of a template's length that a mark of it places, by a loop."""
    words = [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]
    pairs = lambda ws: set(zip(ws, ws[1:])) or {(w,) for w in ws}
    found = set()
    for n, (name, body) in enumerate(templates):
        own = [w for w in re.split("[^a-z0-9]+", body.lower()) if w]
        if not own:
            continue
        chosen = licenses.marks(licenses.template_bigrams(body), threshold)
        for i, w in enumerate(words):
            for j, x in enumerate(own):
                if w == x and w in chosen:
                    first, end = max(0, i - j), min(len(words), i - j + len(own))
                    b = pairs(words[first:end])
                    dice = 2 * len(b & pairs(own)) / (len(b) + len(pairs(own)))
                    if dice >= threshold:
                        found.add((dice, end - first, -n, -first))
    kept = [x for x in found if not any(y > x and -y[3] < -x[3] + x[1] and -x[3] < -y[3] + y[1] for y in found)]
    return sorted((-s, size, templates[-n][0], pytest.approx(dice)) for dice, size, n, s in kept)


APACHE = licenses.TEMPLATES[4][1]
WRAPPED = "\n".join(" ".join(MIT.split()[i:i + 12]) for i in range(0, len(MIT.split()), 12))
RUNS = TEXTS + ["some prose before\n" * 40 + WRAPPED + "\nand prose after" * 40,
                "Read on. This file is Licensed under the Apache License, Version 2.0. Nobody else may say so in the middle of a paragraph.",
                "\n".join("# " + line for line in WRAPPED.split("\n")), "/*\n * " + "\n * ".join(APACHE.split("\n")) + "\n */ int main() {}",
                "Licensed under CC BY-NC 4.0. " * 5, "x " * 30 + WRAPPED + " y" * 30 + APACHE, "mit license " * 300,
                WRAPPED.replace("merge, publish", "publish").replace("fee", "any fee")]


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_runs_against_brute_force(spark, threshold):
    rows = [(i, t, "x") for i, t in enumerate(RUNS)] + [(None, RUNS[3], "x"), (3, RUNS[3], "x")]
    got = licenses.licence_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), threshold=threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        text = RUNS[3] if r.doc_id is None else RUNS[r.doc_id]
        assert [tuple(x) for x in r.runs] == plain_runs(text, licenses.TEMPLATES, threshold), r.doc_id


def test_licences_inside_other_text_are_found(spark):
    got = licenses.licence_runs(spark.createDataFrame([(i, t, "x") for i, t in enumerate(RUNS)], SCHEMA)).collect()
    names = {r.doc_id - len(TEXTS): [x.licence for x in r.runs] for r in got}
    assert names[0] == ["MIT"] and names[1] == ["Apache-2.0"] and names[2] == ["MIT"] and names[3] == ["Apache-2.0"]
    assert names[4] == ["CC-BY-NC-4.0"] * 5 and names[5] == ["MIT", "Apache-2.0"] and names[7] == ["MIT"]


@pytest.mark.parametrize("where", [SMALL, "/root/testdata/sf0.01"])
def test_runs_query(spark, where):
    assert compare(spark, connect(where), "runs", QUERIES["op10_licenses_runs"], ORACLES["op10_licenses_runs"], where) is None


def test_runs_empty(spark):
    docs = spark.createDataFrame([(1, "word", "x")], SCHEMA)
    assert licenses.licence_runs(docs.limit(0)).count() == 0 and licenses.licence_runs(docs, []).first().runs == []
    assert [tuple(x) for x in licenses.licence_runs(docs, [("none", "!"), ("one", "WORD")]).first().runs] == [(0, 1, "one", 1.0)]
