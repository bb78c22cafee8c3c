"""The operators bound to the test tables."""

from __future__ import annotations

import textwrap

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocation, decontaminate, exact_dedup, language, licenses, pii, quality, simhash, spelling, toxicity, warc_zip

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return f
    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_simhash")
def op1(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), size=3, distance=2)


@query("op5_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """)
def op5(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), keep="largest")


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op4_bpe")
def op4(spark, folder):
    encoded = bpe.encode(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), RANKS), 256).alias("decoded_sha256"))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`: tells the documents that labels may be learned from."""
    return F.crc32(doc_id.cast("string")) % by


@query("op9_quality")
def op9(spark, folder):
    docs = table(spark, folder, "documents")
    net = quality.fit(docs, table(spark, folder, "labels"), lambda i: remainder(i, 5) != 0)
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                         quality.score(F.col("text"), net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op6_toxicity")
def op6(spark, folder):
    docs = table(spark, folder, "documents")
    machine = toxicity.fit(docs, table(spark, folder, "labels"), lambda i: remainder(i, 3) != 1)
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                         toxicity.score(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op3_chat")
def op3(spark, folder):
    turns = table(spark, folder, "conversations")
    said = "\\### Assistant: </turn> ok"
    more = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = turns.select("conv_id", "turn", "role", "text").union(more.select(*[
        F.col(c).cast(turns.schema[c].dataType) for c in ("conv_id", "turn", "role", "text")]))
    return chat.read_back(chat.format_turns(turns, chat.text_part(F.col("text"))))


@query("op8_warc_zip")
def op8(spark, folder):
    packages = warc_zip.write_packages(warc_zip.plan_records(table(spark, folder, "pages")))
    return warc_zip.read_packages(spark, packages, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op7_decontaminate")
def op7(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), full=True)


def _licence_sql() -> str:
    values = ",\n".join("({}, '{}', '{}')".format(n, name, " ".join(text.split()).replace("'", "''"))
                        for n, (name, text) in enumerate(licenses.TEMPLATES))
    return f"""
    WITH bodies(n, name, body) AS (VALUES {values}),
    passages AS (
      SELECT doc_id, 0 AS passage, coalesce(text, '') AS body FROM documents
      UNION ALL
      SELECT doc_id, unnest(range(1, len(lines) + 1)), unnest(lines) FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
    split AS (
      SELECT -1 AS n, '' AS name, doc_id, passage, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM passages
      UNION ALL
      SELECT n, name, NULL, NULL, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda x: x <> '') FROM bodies),
    bigrams AS (
      SELECT n, name, doc_id, passage,
             CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS b
      FROM split WHERE len(w) > 0),
    dice AS (
      SELECT p.doc_id, p.passage, t.n, t.name, 2.0::DOUBLE * len(list_intersect(p.b, t.b)) / (len(p.b) + len(t.b)) AS dice
      FROM bigrams p JOIN bigrams t ON p.n < 0 AND t.n >= 0
       AND len(p.b) BETWEEN len(t.b) * 0.66 AND len(t.b) * 1.51),
    best AS (
      SELECT doc_id, passage, arg_max(name, dice * 1000 - n / 1000.0) AS name, max(dice) AS dice
      FROM dice WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, passage)
    SELECT d.doc_id, count(b.passage) AS n_passages, arg_max(b.name, b.dice * 1000000000 - b.passage) AS licence,
           CAST(arg_max(b.passage, b.dice * 1000000000 - b.passage) AS INTEGER) AS passage, max(b.dice) AS dice
    FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id GROUP BY d.doc_id
    """


@query("op10_licenses", _licence_sql())
def op10(spark, folder):
    return op10_found(spark, folder).drop("found")


def _runs_sql() -> str:
    quote = lambda w: w.replace("'", "''")
    values = ", ".join(f"({n}, '{name}', '{' '.join(licenses.template_words(text))}')" for n, (name, text) in enumerate(licenses.TEMPLATES))
    marked = ", ".join(f"({n}, '{quote(w)}', {j})" for n, (_, text) in enumerate(licenses.TEMPLATES) for w, j in licenses.anchors(text, licenses.THRESHOLD))
    bigrams = lambda w: f"CASE WHEN len({w}) > 1 THEN list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])) ELSE {w} END"
    return f"""
    WITH bodies(n, name, body) AS (VALUES {values}), anchors(n, word, j) AS (VALUES {marked}),
    templates AS (SELECT n, name, len(t) AS size, {bigrams("t")} AS b FROM (SELECT n, name, string_split(body, ' ') AS t FROM bodies)),
    texts AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
    placed AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
    starts AS (SELECT DISTINCT p.doc_id, t.n, p.i - a.j AS s FROM placed p JOIN anchors a ON a.word = p.word JOIN templates t ON t.n = a.n),
    cut AS (
      SELECT DISTINCT s.doc_id, t.n, t.name, t.b AS own, greatest(s, 0) AS start, least(s + size, len(w)) - greatest(s, 0) AS words,
             w[greatest(s, 0) + 1 : least(s + size, len(w))] AS part
      FROM starts s JOIN templates t ON t.n = s.n JOIN texts x ON x.doc_id = s.doc_id),
    compared AS (SELECT doc_id, n, name, start, words, own, {bigrams("part")} AS b FROM cut),
    alike AS (
      SELECT doc_id, n, name, start, words, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS dice FROM compared
      WHERE 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) >= {licenses.THRESHOLD}),
    best AS (
      SELECT * FROM alike x WHERE NOT EXISTS (
        SELECT 1 FROM alike y WHERE y.doc_id = x.doc_id AND y.start < x.start + x.words AND x.start < y.start + y.words
          AND (y.dice > x.dice OR y.dice = x.dice AND (y.words > x.words OR y.words = x.words AND (y.n < x.n OR y.n = x.n AND y.start < x.start)))))
    SELECT d.doc_id, count(b.start) AS n_runs, coalesce(string_agg(b.start || ':' || b.words || ':' || b.name, ',' ORDER BY b.start, b.words, b.name), '') AS runs,
           max(b.dice) AS dice
    FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id GROUP BY d.doc_id
    """


@query("op10_licenses_runs", _runs_sql())
def op10_runs(spark, folder):
    """Licences anywhere in whole texts: wrapped over lines, in the middle of a paragraph, behind comment marks."""
    found = licenses.licence_runs(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r["start"], r["words"], r["licence"])), ",").alias("runs"),
        F.array_max(F.transform("runs", lambda r: r["dice"])).alias("dice"))


@query("op10_licenses_found")
def op10_found(spark, folder):
    found = licenses.licences(table(spark, folder, "documents"))
    best = F.array_max(F.transform("found", lambda f: F.struct(
        f["dice"].alias("dice"), (-f["passage"]).alias("minus"), f["licence"].alias("licence"))))
    return found.select("doc_id", "found", F.size("found").cast("long").alias("n_passages"), best.alias("best")).select(
        "doc_id", "n_passages", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("passage"),
        F.col("best.dice").alias("dice"), "found")


@query("op2_pii")
def op2(spark, folder):
    found = pii.whole_spans(table(spark, folder, "documents"))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    terms = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.concat("base", terms)).alias("spans"))


@query("op13_language")
def op13(spark, folder):
    docs = table(spark, folder, "documents")
    prototypes = language.learn(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    found = language.identify(F.col("text"), prototypes).alias("found")
    return docs.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), found).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query("op11_spelling")
def op11(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"), least_letters=5, least=3)


@query("op12_collocation", """
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
      FROM documents),
    words AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
    phrases AS (
      SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
      FROM words, (VALUES (1), (2), (3)) AS sizes(size) WHERE len(w) >= size),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    f AS (SELECT lang, size, phrase, count(*) AS a FROM phrases GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (
      SELECT lang, size, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
      FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)),
    scores AS (
      SELECT c.*, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
    lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, part, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS part
        FROM f WHERE size = 3) GROUP BY lang, part),
    kept AS (
      SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
      WHERE g.a IS NULL OR 100 * g.a < 50 * s.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """)
def op12(spark, folder):
    return collocation.collocations(table(spark, folder, "documents"), support=10, longest=3, inside=50, top=2000)
