"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import INNER, staged, texts

#: Dimensions of a vector, letters of an n-gram, seed of the letter vectors, languages that get a prototype (those with most documents).
DIMENSIONS, LETTERS, SEED, LANGUAGES = 1024, 3, 13, 5000
#: Prediction for texts without a letter, and where nothing was learned.
UNKNOWN = "und"
#: A document's unit vector counts this often in a prototype, so that sums are whole numbers and do not hang on their order.
UNIT = 1 << 16
#: n-grams whose vectors a task builds at once; letters it remembers.
SLICE, REMEMBERED = 4096, 20_000

_IS_LETTER = np.zeros(0, bool)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters and both ends as one 0."""
    global _IS_LETTER
    if not len(_IS_LETTER):
        _IS_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[0], np.where(_IS_LETTER[points], points, 0), [0]]).astype(np.int64)
    return points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text as packed code points, and how often each occurs. A text without a letter has none."""
    points = letters(text)
    codes = np.zeros(max(0, len(points) - LETTERS + 1), np.int64)
    for i in range(LETTERS):
        codes = codes << 21 | points[i:i + len(codes)]
    return np.unique(codes, return_counts=True)


class Space:
    """Letter vectors of random signs, and what binding and bundling make of them."""

    def __init__(self):
        self.known: dict[int, int] = {}
        self.rolled = np.zeros((LETTERS, 64, DIMENSIONS), np.int8)

    def _places(self, points: np.ndarray) -> np.ndarray:
        for p in points.tolist():
            if p not in self.known:
                at = self.known[p] = len(self.known)
                if at == self.rolled.shape[1]:
                    self.rolled = np.concatenate([self.rolled, np.zeros_like(self.rolled)], axis=1)
                signs = np.random.default_rng([SEED, p]).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1
                for i in range(LETTERS):
                    self.rolled[i, at] = np.roll(signs, LETTERS - 1 - i)
        return np.array([self.known[p] for p in points.tolist()])

    def bind(self, codes: np.ndarray) -> np.ndarray:
        """n-gram vectors: the product of the letters' vectors, each permuted by its distance from the last letter."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        points, at = np.unique([codes >> 21 * (LETTERS - 1 - i) & 0x1FFFFF for i in range(LETTERS)], return_inverse=True)
        places = self._places(points)[at].reshape(LETTERS, len(codes))
        out = self.rolled[0][places[0]]
        for i in range(1, LETTERS):
            out *= self.rolled[i][places[i]]
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the n-gram vectors, each as often as it occurs; whole numbers, exact."""
        total = np.zeros(DIMENSIONS)
        kind = np.float32 if counts.sum() < 1 << 24 else np.float64
        for at in range(0, len(codes), SLICE):
            total += counts[at:at + SLICE].astype(kind) @ self.bind(codes[at:at + SLICE]).astype(kind)
        return total


def learn(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", languages: int = LANGUAGES) -> dict[str, np.ndarray]:
    """Prototypes by language: the bundle of all its documents in `docs`, each scaled to unit length.

    Every row with a language and a letter counts, repeated ones each time. Tasks add up their documents, so that what is shuffled is one vector per task
    and language, and only the prototypes reach the driver: those of the `languages` languages with most documents (ties: the
    smaller name). No such row: no prototypes.
    """
    rows = texts(docs, lang_column, text_column).select(F.col("doc_id").cast("string").alias("lang"), "text").dropna()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(), {}

        def flush():
            out = pa.record_batch([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                                  ["lang", "parts"])
            sums.clear()
            return out

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = ngrams(text)
                if len(codes):
                    whole = space.bundle(codes, counts)
                    unit = np.rint(whole * (UNIT / max(1.0, np.sqrt(whole @ whole)))).astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + np.append(unit, 1)
                if len(sums) > 200:
                    yield flush()
        yield flush()

    parts = rows.mapInArrow(added, "lang string, parts array<long>").select("lang", F.posexplode("parts").alias("at", "value"))
    sums = staged(parts.groupBy("lang", "at").agg(F.sum("value").alias("value")), "prototypes")
    kept = sums.filter(F.col("at") == DIMENSIONS).orderBy(F.desc("value"), "lang").limit(languages).select(F.col("lang").alias(f"{INNER}lang"))
    sums = sums.join(kept, F.col("lang") == F.col(f"{INNER}lang")).filter(F.col("at") < DIMENSIONS)
    found: dict[str, np.ndarray] = {}
    for row in sums.select("lang", "at", "value").collect():
        found.setdefault(row.lang, np.zeros(DIMENSIONS))[row.at] = row.value
    return dict(sorted(found.items()))


def identify(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """struct(lang, score) of a whole text: the prototype of the highest cosine (ties: the smallest name) and that cosine, at
    least 0. Null texts, texts without a letter, and every text if there is no prototype: `und` and 0. Local to a row.
    """
    names = list(prototypes)
    matrix = np.array([v / max(1.0, np.sqrt(v @ v)) for v in prototypes.values()]).reshape(len(names), DIMENSIONS)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        space = Space()

        def best(text: str) -> dict:
            codes, counts = ngrams(text)
            if not len(codes) or not names:
                return {"lang": UNKNOWN, "score": 0.0}
            whole = space.bundle(codes, counts)
            cosines = matrix @ whole / max(1.0, np.sqrt(whole @ whole))
            at = int(cosines.argmax())
            return {"lang": names[at], "score": min(1.0, max(0.0, float(cosines[at])))}

        for column in columns:
            yield pa.array([best(t.as_py() or "") for t in column], kind)

    return of(text)
