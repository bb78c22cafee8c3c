"""Personal data against the plain patterns; disclosure against brute force."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import pii
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, s):
    digits = re.sub(r"[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m[0])]


@pytest.mark.parametrize("seed", range(20))
def test_finders_equal_the_patterns(seed):
    rng = random.Random(seed)
    bits = ["a", "B.", "@", "x@y.z", "1.2.3.4", ".", "-", " ", "+", "+1 (202) 555-0100", "4111 1111 1111 1111", "é", "256", "0", "7", "@@", "\n", "5500-0000-0000-0004"]
    for _ in range(400):
        text = "".join(rng.choices(bits, k=rng.randrange(30)))
        assert pii.find(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 200_000, "+" * 200_000, "+1" + " " * 300_000, "@" * 200_000, "a@" * 100_000, "0 " * 200_000])
def test_long_runs_take_linear_time(text):
    pii.find(text)


def test_query_base(spark):
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans = plain(d.text or "")
        r, written = got[d.doc_id], [f"{k}:{a}:{b}" for k, a, b in spans]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        whole = [s for s in r.spans.split(",") if s]
        assert whole[:len(written)] == written and all(s.startswith("term:") for s in whole[len(written):])
    assert sum(len(plain(d.text or "")) for d in docs) > 20


def corpus():
    """Mail a@x.org is always near the word heron, which is rare elsewhere; b@x.org near words that are everywhere."""
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(60):
        words = rng.choices(filler, k=30)
        if i % 6 == 0:
            words[10:10] = ["Heron", "a@x.org"]
        if i % 5 == 1:
            words[20:20] = ["B@X.org"]
        docs.append((i, " ".join(words)))
    docs += [(100 + i, docs[0][1]) for i in range(10)]  # copies of one context
    copied = "unique quokka here c@x.org indeed"
    return docs + [(200 + i, copied) for i in range(20)] + [(300, None), (301, ""), (None, "a@x.org heron 4111111111111111")]


def test_sanitise(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, base string").repartition(4)
    out = pii.sanitise(frame)
    assert out.columns == frame.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(docs) and got[300] is None and got[301] == ""
    assert not any("eron" in t or "@" in t for t in got.values() if t)
    assert got[None].count("[EMAIL]") == got[None].count("[CARD]") == 1
    assert "[EMAIL]" in got[205] and "quokka" not in got[205]
    assert got[3] == dict(docs)[3] or "[EMAIL]" in got[3]


def test_redact():
    assert pii.redact("Bob 42 a@b.c x", [("email", 7, 12)], [(0, 3, .8, "generalise"), (4, 6, .8, "generalise"), (13, 14, 1.0, "remove")]) == "[NAME] [NUMBER] [EMAIL] "


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.whole_spans(empty).count() == 0 and pii.sanitise(empty).count() == 0


def far_corpus():
    """a@x.org and the name Ondrasik stand 50 words apart, always in the same words; three texts hold the name only."""
    rng = random.Random(9)
    filler = [f"w{i}" for i in range(40)]
    apart = " ".join(filler)
    signed = [(i, f"Ondrasik {apart} w1 w2 w3 a@x.org 1.2.3.4") for i in range(20)]
    named = [(100 + i, f"w{i} ondrasik came") for i in range(3)]
    return signed + named + [(200 + i, " ".join(rng.choices(filler, k=20))) for i in range(400)] + [
        (700, "b@y.org and nobody else has marzipan"), (701, None), (702, ""), (None, "c@z.org"), (0, signed[0][1])]


def brute_whole(docs):
    texts = [t or "" for _, t in docs]
    free = []
    for t in texts:
        spans = plain(t)
        free.append([m for m in re.finditer(r"[^\W_]+", t) if not any(a < m.end() and m.start() < b for _, a, b in spans)])
    words = [{m[0].lower() for m in f} for f in free]
    held = [{pii.entity(k, t[a:b]) for k, a, b in plain(t)} for t in texts]
    holders = {frozenset(n for n, h in enumerate(held) if e in h) for e in set().union(*held)}
    found = {}
    for rows in holders:  # entities of the same rows are one
        for w in set().union(*(words[n] for n in rows)):
            both, df = sum(w in words[n] for n in rows), sum(w in x for x in words)
            value = pii.lowest_share(both, df, len(rows), len(docs))
            if both > 1 and value is not None and value >= pii.GENERALISE:
                found[rows, w] = (value, pii.evidence(both, df, len(rows), len(docs)))
    tests, least = len(set().union(*words)) * len(holders), math.inf
    for x in sorted({math.floor(e * 4) / 4 for _, e in found.values()}):
        if tests * math.exp(-x) <= 0.01 * sum(e >= x for _, e in found.values()):
            least = min(least, x)
    share = {}
    for (_, w), (value, e) in found.items():
        if e >= least:
            share[w] = max(share.get(w, 0), value)
    return share, {(i, t or ""): [(m.start(), m.end(), "remove" if share[m[0].lower()] >= pii.REMOVE else "generalise")
                                  for m in f if m[0].lower() in share] for (i, t), f in zip(docs, free)}


@pytest.mark.parametrize("block", [1, 1000])
def test_whole_texts_against_brute_force(spark, block):
    docs = far_corpus()
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, terms string").repartition(4)
    got = pii.whole_spans(frame, block_terms=block).collect()
    share, want = brute_whole(docs)
    texts = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        text = texts[r.doc_id] or ""
        assert [(s.start, s.end, s.action) for s in r.terms] == want[r.doc_id, text]
        assert [s.share for s in r.terms] == pytest.approx([share[text[s.start:s.end].lower()] for s in r.terms])
        assert [tuple(s) for s in r.base] == plain(text)
    assert "ondrasik" in share and "marzipan" not in share and "w1" not in share


def test_whole_sanitise_cleans_texts_without_entities(spark):
    docs = far_corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert len(got) == len(dict(docs)) and got[701] is None
    assert not any("ndrasik" in t for t in got.values() if t)


def test_query_terms_against_brute_force(spark):
    """The spans of the query over a whole table."""
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    _, want = brute_whole(docs)
    for r in QUERIES["op2_pii"](spark, folder).collect():
        text = dict(docs)[r.doc_id] or ""
        spans = [f"{k}:{a}:{b}" for k, a, b in plain(text)] + [f"term:{a}:{b}" for a, b, _ in want[r.doc_id, text]]
        assert r.spans == ",".join(spans)


@pytest.mark.parametrize("total", [10 ** n for n in range(3, 10)])
def test_one_shared_text_is_never_enough(total):
    """Words of one text each, thrown at random: whatever the size of the corpus, those that fall to an entity of one text prove nothing."""
    rare, entities = 30 * total, total // 20
    singles = max(1, rare * entities // total)
    found = {math.floor(pii.evidence(1, 1, 1, total) * pii.STEPS): singles}
    assert pii.least_evidence(found, rare * entities) == math.inf
    # five texts of five are enough at any size, also among all those singles, and hold their share
    found[math.floor(pii.evidence(5, 5, 5, total) * pii.STEPS)] = 20
    least = pii.least_evidence(found, rare * entities)
    assert pii.evidence(1, 1, 1, total) < least and (total < 10 ** 4 or least <= pii.evidence(5, 5, 5, total))
    assert pii.lowest_share(5, 5, 5, total) > pii.lowest_share(1, 5, 1, total)


def planted(n, seed=2):
    """n texts of 30 words out of 3,000; 40 people with a mail address in 6 texts each, always with their own rare name; every tenth other text has an address of its own."""
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(30)) + f" once{i}" for i in range(n)]
    names = set()
    for person in range(40):
        names.add(f"name{person}")
        for i in rng.sample(range(0, n // 2), 6):
            texts[i] += f" name{person} p{person}@x.org"
    for i in range(n // 2, n, 10):
        texts[i] += f" q{i}@y.org"
    return list(enumerate(texts)), names


def test_planted_names_are_found_and_others_left_alone(spark):
    docs, names = planted(3000)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = pii.whole_spans(frame, block_terms=15).collect()  # three blocks
    found = {dict(docs)[r.doc_id][s.start:s.end] for r in rows for s in r.terms}
    assert len(found & names) >= 0.9 * len(names)
    assert len(found - names) <= 2  # nothing of the 3,000 words, nor of those that stand in one text
    actions = {s.action for r in rows for s in r.terms}
    assert actions <= {"generalise", "remove"}


def test_many_shared_texts_lead_to_removal(spark):
    docs = [(i, f"w{i % 50} w{i % 31} Zebedee z@x.org") for i in range(150)] + [(1000 + i, f"w{i % 50} w{i % 31}") for i in range(4000)] + [(9000, "Zebedee alone")]
    got = {r.doc_id: r for r in pii.whole_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert [s.action for s in got[9000].terms] == ["remove"] and not got[1000].terms


def test_few_documents_prove_less():
    shares = [pii.lowest_share(n, n, n, 10_000) for n in (1, 2, 5, 20, 100)]
    assert shares == sorted(shares) and shares[0] < pii.REMOVE < shares[-1] < 1
    assert pii.lowest_share(1, 5, 1, 10_000) < pii.lowest_share(5, 5, 5, 10_000)
    assert pii.lowest_share(7, 7, 7, 7) is None


def test_an_entity_of_one_context_has_terms(spark):
    docs = [(i, "signed by Quill at a@x.org") for i in range(20)] + [(100 + i, "signed by nobody at all") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) text_key", "text")
    got = {r.term: (r.entities, r.share) for r in pii.disclosing_terms(frame).collect()}
    assert got == {"quill": (1, pytest.approx(pii.lowest_share(20, 20, 20, 420)))}
