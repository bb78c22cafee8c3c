"""Information-theoretic sanitisation: personal data, and the terms near it that reveal it."""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import INNER, keyed_join, staged, texts

#: Kinds of personal data in the order of the results; `term` is what the method adds.
KINDS = ("email", "ip", "card", "phone")
#: Shares of an entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.7, 0.9

#: Different terms, or pairs of entity and term, a task counts before it hands them on.
HELD_TERMS = 200_000
#: Normal quantile of the one-sided 95 % bound on small counts; disclosing terms sent to the tasks at once.
BOUND, BLOCK_TERMS = 1.645, 300_000
#: Share of the disclosing pairs that may be chance; steps in which evidence is counted per nat, and the most that is told apart.
FALSE_RATE, STEPS, MOST_EVIDENCE = 0.01, 4, 400.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain in one pass: a local part reaches back to the last character it may not hold."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts of a dotted chain of numbers are a match; it counts if no part is over 255."""
    for chain in _CHAIN.finditer(text):
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones)))


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the personal data in a text, in code points, by kind and start."""
    return [(kind, a, b) for kind, spans in FINDERS.items() for a, b in spans(text)]


def entity(kind: str, text: str) -> str:
    """The same entity is written in several ways: letters in lower case, digits only for numbers."""
    return kind + ":" + (text.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 42) - (1 << 63)


def free_words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """The words of a text that no span touches, in order."""
    ordered = sorted((a, b) for _, a, b in spans)
    s = reach = 0
    for m in _WORD.finditer(text):
        while s < len(ordered) and ordered[s][0] < m.end():
            reach = max(reach, ordered[s][1])
            s += 1
        if m.start() >= reach:
            yield m


SPANS = "array<struct<kind string, start int, end int>>"


def lowest_share(both: int, docs: int, entity_docs: int, total: int, bound: float = BOUND) -> float | None:
    """PMI(entity; term) / IC(entity) with P(entity | term) = both / docs at its lower Wilson bound, so a few documents prove less
    than many. None for an entity of all documents, which has no information.
    """
    p, z = both / docs, bound * bound
    low = (p + z / (2 * docs) - bound * math.sqrt(p * (1 - p) / docs + z / (4 * docs * docs))) / (1 + z / docs)
    information = math.log2(total / entity_docs)
    return math.log2(low * total / entity_docs) / information if information > 0 else None


def _lowest_share(both: Column, docs: Column, entity_docs: Column, total: int, bound: float) -> Column:
    """`lowest_share` of columns."""
    p, z = both / docs, bound * bound
    low = (p + z / (2 * docs) - bound * F.sqrt(p * (1 - p) / docs + z / (4 * docs * docs))) / (1 + z / docs)
    information = F.log2(F.lit(float(total)) / entity_docs)
    return F.when(information > 0, F.log2(low * float(total) / entity_docs) / information)


def evidence(both: float, docs: float, entity_docs: float, total: float) -> float:
    """Nats against chance: minus the logarithm of a bound on the probability that `both` or more of the texts with a term hold the entity, if
    its texts were drawn at random (Chernoff's bound for a Poisson count).
    """
    expected = docs * entity_docs / total
    return both * math.log(both / expected) - both + expected if both > expected else 0.0


def _evidence(both: Column, docs: Column, entity_docs: Column, total: int) -> Column:
    """`evidence` of columns."""
    expected = docs * entity_docs / float(total)
    return F.when(both > expected, both * F.ln(both / expected) - both + expected).otherwise(0.0)


def least_evidence(found: dict[int, int], tests: float, rate: float = FALSE_RATE) -> float:
    """The evidence from which at most a share of `rate` of the pairs is expected to be chance, by Benjamini and Hochberg: of `tests` pairs
    (terms times entities) chance gives tests * exp(-x) with evidence x; `found` counts the pairs seen, by evidence in STEPS per nat, rounded down.
    """
    least, seen = math.inf, 0
    for step in sorted(found, reverse=True):
        seen += found[step]
        if math.log(tests) - step / STEPS <= math.log(rate * seen):
            least = step / STEPS
    return least


def _holdings(docs: DataFrame) -> DataFrame:
    """Of (doc_id, text_key, text) in one pass: a row (doc_id, text_key, entities, words) for each text with entities, both distinct; and
    rows (term, n) with the number of texts that hold a word, combined in each task, HELD_TERMS at a time.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "entities", "words", "term", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, kind = Counter(), pa.int64()
        longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())

        def flushed() -> pa.RecordBatch:
            n = len(count)
            batch = [pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, longs), pa.nulls(n, strings),
                     pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())]
            count.clear()
            return pa.RecordBatch.from_arrays(batch, names)

        for batch in batches:
            kind, rows, entities, held = batch.column(0).type, [], [], []
            for i, text in enumerate(batch.column(2)):
                text = text.as_py()
                spans = find(text)
                own = {m[0].lower() for m in free_words(text, spans)}
                count.update(own)
                if spans:
                    rows.append(i)
                    entities.append(sorted({_hash(entity(k, text[a:b])) for k, a, b in spans}))
                    held.append(sorted(own))
            at, n = pa.array(rows, pa.int64()), len(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(entities, longs), pa.array(held, strings),
                                              pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], names)
            if len(count) > HELD_TERMS:
                yield flushed()
        if count:
            yield flushed()

    return docs.mapInArrow(run, f"doc_id {id_type}, text_key long, entities array<long>, words array<string>, term string, n long")


def _pairs(rows: DataFrame) -> DataFrame:
    """(holder, term, both) of (holders, words): in how many rows each pair occurs; combined in each task before the shuffle."""
    def flushed(count: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([h for h, _ in count], pa.int64()), pa.array([t for _, t in count], pa.string()),
                                            pa.array(list(count.values()), pa.int64())], ["holder", "term", "n"])
        count.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter()
        for batch in batches:
            for holders, own in zip(batch.column(0), batch.column(1)):
                own = own.as_py()
                for h in holders.as_py():
                    count.update((h, t) for t in own)
                    if len(count) > HELD_TERMS:
                        yield flushed(count)
        if count:
            yield flushed(count)

    return rows.select("holders", "words").mapInArrow(run, "holder long, term string, n long").groupBy("holder", "term").agg(F.sum("n").alias("both"))


def disclosing_terms(docs: DataFrame, least: float = GENERALISE, bound: float = BOUND) -> DataFrame:
    """(entity, entities, term, share) over whole texts of (doc_id, text_key, text): `lowest_share` from the number of rows with the entity, with the
    term, and with both, wherever they stand; shares below `least` are left out. A word counts where it is no part of an entity.

    A rare word of a text with an entity always seems to reveal it, and the more so the larger the corpus. So pairs must also hold against chance:
    their `evidence` must reach what `least_evidence` asks for all pairs of terms and entities. One shared text is never enough.

    Entities of the same rows have the same counts for every term, so they are counted together: `entity` is the smallest hash of
    them, `entities` their number. A text that lists thousands of addresses found nowhere else gives one set of pairs.
    """
    seen = staged(_holdings(docs), "holdings")
    rows, total = seen.filter(F.col("term").isNull()), docs.count()
    key = ["doc_id", "text_key"]
    listed = rows.select(*key, F.explode("entities").alias("entity"))
    place = F.xxhash64(*key)
    held = listed.groupBy("entity").agg(F.count("*").alias("entity_docs"), F.sum(place.cast("decimal(38,0)")).alias("sum"), F.bit_xor(place).alias("xor"))
    classes = staged(held.groupBy("entity_docs", "sum", "xor").agg(F.min("entity").alias("holder"), F.count("*").alias("entities")), "classes")
    # the smallest entity of a class stands for it; the others have no pairs of their own
    first = keyed_join(listed, classes.select(F.col("holder").alias("entity")), "entity", "left_semi")
    holders = first.groupBy(*key).agg(F.collect_set("entity").alias("holders"))
    pairs = _pairs(keyed_join(rows.select(*key, "words"), holders, key))
    known = keyed_join(pairs, classes.select("holder", "entity_docs", "entities"), "holder")
    frequency = staged(seen.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("docs")), "words")
    both, docs_with, holding = F.col("both"), F.col("docs"), F.col("entity_docs")
    counted = keyed_join(known.filter(both > 1), frequency, "term").select(
        F.col("holder").alias("entity"), "entities", "term", _lowest_share(both, docs_with, holding, total, bound).alias("share"),
        F.least(_evidence(both, docs_with, holding, total), F.lit(MOST_EVIDENCE)).alias("evidence")).filter(F.col("share") >= least)
    counted = staged(counted, "pairs")
    steps = counted.groupBy(F.floor(F.col("evidence") * STEPS).cast("int").alias("step")).count().collect()
    enough = least_evidence({r["step"]: r["count"] for r in steps}, max(1.0, float(frequency.count()) * classes.count()))
    return counted.filter(F.col("evidence") >= F.lit(enough)).drop("evidence")


def _blocks(terms: DataFrame, most: int) -> Iterator[list]:
    """(term, share) in lists of about `most` rows: what is sent to the executors at once is bounded."""
    count = max(1, -(-terms.count() // most))
    for b in range(count):
        yield [tuple(r) for r in terms.filter(F.pmod(F.xxhash64("term"), F.lit(count)) == b).collect()]


def whole_spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, bound: float = BOUND, id_column: str = "doc_id",
                text_column: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(doc_id, text_key, base, terms), one row per row of `docs`.

    `base`: (kind, start, end) of e-mail addresses, IP addresses, payment cards and phone numbers in the whole text, in code points, by
    kind and start. `terms`: (start, end, share, action) of every occurrence of a disclosing term, also in texts without any personal data; action is
    generalise or remove by the share of the entity's information that the term gives away; by start. A term is counted with an entity wherever both
    stand in one row's text. Null texts are empty, rows without id and rows that repeat an id keep their own spans, copies count as rows,
    an empty table gives no rows, other columns are not read.

    Few rows prove little, by `lowest_share` and `least_evidence`. A term that reveals several entities has the
    largest share. Texts are read once for the counts and once for each block of `block_terms` disclosing terms; between two
    blocks they are staged. Shuffles carry entities, the words of texts with entities, and word counts, combined in each task.
    """
    rows = texts(docs, id_column, text_column).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    reveal = staged(disclosing_terms(rows, generalise, bound).groupBy("term").agg(F.max("share").alias("share")), "reveal")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("share", pa.float64()), ("action", pa.string())])
    kind = "array<struct<start int, end int, share double, action string>>"

    def marked(sent):
        @F.arrow_udf(kind)
        def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            share = dict(sent.value)
            for column in columns:
                out = []
                for text in column:
                    text = text.as_py()
                    out.append([(m.start(), m.end(), s, "remove" if s >= remove else "generalise")
                                for m in free_words(text, find(text)) if (s := share.get(m[0].lower())) is not None])
                yield pa.array([[dict(zip(("start", "end", "share", "action"), x)) for x in found] for found in out], pa.list_(span))

        return of(F.col("text"))

    @F.arrow_udf(SPANS)
    def personal(column: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py())] for t in column],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    found = F.array().cast(kind)
    for b, terms in enumerate(_blocks(reveal, block_terms)):
        if b:
            rows, found = staged(rows.withColumn("terms", found), "terms"), F.col("terms")
        found = F.concat(found, marked(rows.sparkSession.sparkContext.broadcast(terms)))
    return rows.select("doc_id", "text_key", personal("text").alias("base"), F.sort_array(found).alias("terms"))


def redact(text: str, base: list, terms: list) -> str:
    """Personal data become their kind in brackets, terms a class or nothing; where spans overlap, the earlier and longer one counts."""
    cuts = [(a, -b, f"[{k.upper()}]") for k, a, b in base]
    for a, b, _, action in terms:
        word = text[a:b]
        general = "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[TERM]"
        cuts.append((a, -b, general if action == "generalise" else ""))
    out, at = [], 0
    for a, b, put in sorted(cuts):
        if a >= at:
            out += [text[at:a], put]
            at = -b
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """`docs` with the text replaced by its sanitised form; all columns and rows kept, null texts stay null.

    Spans are those of `whole_spans`, so that texts which name no entity are cleaned as well.
    """
    names = {c: f"{INNER}{c}" for c in ("doc_id", "text_key", "base", "terms")}
    spans = whole_spans(docs, id_column=id_column, text_column=text_column, **how).dropDuplicates(["doc_id", "text_key"]).filter(
        "size(base) > 0 or size(terms) > 0").withColumnsRenamed({c: n for c, n in names.items() if c in ("base", "terms")})
    text = F.col(f"`{text_column}`")

    @F.arrow_udf("string")
    def clean(texts: pa.Array, base: pa.Array, terms: pa.Array) -> pa.Array:
        return pa.array([t if t is None or b is None else redact(t, [tuple(x.values()) for x in b], [tuple(x.values()) for x in m])
                         for t, b, m in zip(texts.to_pylist(), base.to_pylist(), terms.to_pylist())], pa.string())

    keyed = docs.withColumns({f"{INNER}id": F.col(f"`{id_column}`"), f"{INNER}key": F.xxhash64(F.coalesce(text, F.lit("")))})
    spans = spans.withColumnsRenamed({"doc_id": f"{INNER}id", "text_key": f"{INNER}key"})
    joined = keyed_join(keyed, spans, [f"{INNER}id", f"{INNER}key"], "left")
    return joined.withColumn(text_column, clean(text, F.col(names["base"]), F.col(names["terms"]))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
