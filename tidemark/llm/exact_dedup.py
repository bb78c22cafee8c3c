"""Exact deduplication with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import INNER, keyed_join, staged, texts


def md5_128(text: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", id_column: str = "doc_id", text_column: str = "text",
                     content_hash=md5_128) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    Texts are grouped by their 128-bit hash and compared byte for byte inside a group: the grouping key is (hash, text), so
    texts that only share a hash stay apart. Copies collapse in each task before the shuffle; only the count and one id of a
    group meet, however large it is. Rows find their group by hash and SHA-256, without a second shuffle of texts;
    should two different texts agree in both, the query fails instead of giving a wrong row.

    Null texts count as empty. Of equal texts the row with the `keep`-est ("smallest" or "largest") id stays; a null id
    loses to every other id, and a group of null ids only has a null keep_id and keeps its rows. Rows that repeat an id and its
    text are one document: all carry the same decision. An empty table gives no rows; other columns are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    rows = texts(docs, id_column, text_column).withColumn("hash", content_hash(F.col("text")))
    sha = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("sha")
    exact = rows.groupBy("hash", "text").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = exact.select("hash", sha, "keep_id", "group_size").groupBy("hash", "sha").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.count("*").alias("texts"))
    size = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share both digests")))
    return keyed_join(rows.select("doc_id", "hash", sha), groups, ["hash", "sha"]).select(
        "doc_id", "keep_id", size.alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest", id_column: str = "doc_id",
                          text_column: str = "text") -> DataFrame:
    """`docs` with one row for each different text, all its columns kept; rules as in `exact_duplicates`.

    Of rows that repeat an id and its text one stays. The decisions are staged as a narrow table; texts are shuffled again
    only where the rows to drop are too many to be broadcast.
    """
    keys = [f"{INNER}id", f"{INNER}sha"]
    decided = staged(exact_duplicates(docs, keep, id_column, text_column).select(
        F.col("doc_id").alias(keys[0]), F.unhex("text_sha256").alias(keys[1]), "kept"), "exact")
    dropped = decided.filter("not kept").select(keys).distinct()
    repeated = staged(decided.filter("kept").groupBy(keys).count().filter("count > 1").select(keys), "repeated")
    sha = F.unhex(F.sha2(F.encode(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), "UTF-8"), 256))
    stays = keyed_join(docs.withColumns({keys[0]: F.col(f"`{id_column}`"), keys[1]: sha}), dropped, keys, "left_anti")
    once = keyed_join(stays, repeated, keys, "left_anti")
    again = keyed_join(stays, repeated, keys, "left_semi").dropDuplicates(keys)
    return once.union(again).drop(*keys)
