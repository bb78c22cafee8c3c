"""Helpers the operators share: null-safe texts, own shuffles, staged tables, components of a link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from ..tables import files

#: Names the operators use beside columns of the caller start like this, so they cannot clash.
INNER = "__llm_"


#: Rows in an Arrow batch: texts are long, and a batch is held whole on both sides of the pipe to Python.
ARROW_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, its session set to Arrow batches of at most ARROW_ROWS rows; a smaller setting stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty) under fixed names; other columns are not read."""
    return small_batches(docs).select(F.col(f"`{id_column}`").alias("doc_id"),
                                      F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again: lineage ends there, lost executors cost nothing, and
    the planner knows the table's size. The folder goes when the application ends.
    """
    spark = df.sparkSession
    folder = new_folder(spark, f"llm-{label}")
    fs, path = files._path(spark, folder)
    fs.deleteOnExit(path)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_staged(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        files.remove(spark, folder)


def keyed_join(df: DataFrame, side: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be hot in `df` and are unique (or bounded) in `side`.

    Each side gets a shuffle of its own, so that adaptive execution can split a hot key even where `side` was just
    aggregated by it; a side below Catalyst's limit is broadcast. Null keys match null keys.
    """
    keys = [keys] if isinstance(keys, str) else keys
    side = side.withColumnsRenamed({k: f"{INNER}{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"`{INNER}{k}`"))
    joined = df.join(side, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"{INNER}{k}" for k in keys])


def labelled_sample(docs: DataFrame, labels: DataFrame, learn_from, label: str, id_column: str, text_column: str,
                    rows: int) -> DataFrame:
    """(doc_id, text, label) of labelled documents whose id satisfies `learn_from`, for at most `rows` ids, drawn by the
    hash of the id. Contradicting labels count as the higher one; rows without id or label are left out.
    """
    known = labels.select(F.col(f"`{id_column}`").alias(f"{INNER}id"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    known = known.filter(learn_from(F.col(f"{INNER}id"))).groupBy(f"{INNER}id").agg(F.max("label").alias("label"))
    # labels of documents that are gone must not use up the bound
    here = docs.select(F.col(f"`{id_column}`").alias("doc_id"))
    picked = known.join(here, F.col(f"{INNER}id") == F.col("doc_id"), "left_semi")
    picked = picked.orderBy(F.xxhash64(f"{INNER}id"), f"{INNER}id").limit(rows)
    return texts(docs, id_column, text_column).join(picked, F.col("doc_id") == F.col(f"{INNER}id")).drop(f"{INNER}id")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of `links` (two columns of comparable ids, a != b); component is the smallest
    node that can be reached.

    Alternating large-star and small-star steps: links shrink to stars in a logarithmic number of rounds. Nothing is
    collected; minima are combined before each shuffle, and every round ends in a staged table.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before, seen = None, state(now)
    while seen != before and seen[0]:
        both = now.union(now.select(v.alias("u"), u.alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = keyed_join(both, smallest, "u").filter(v > u).select(v.alias("u"), m.alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        # every lower neighbour moves to the lowest one, and so does the node itself
        small = keyed_join(large, lowest, "u").select(
            F.explode(F.array(F.struct(v.alias("u"), m.alias("v")), F.struct(u.alias("u"), m.alias("v")))).alias("e"))
        after = staged(small.select("e.u", "e.v").filter(u != v).distinct(), "links")
        before, seen = seen, state(after)
        drop_staged(now)
        now = after
    return now.select(u.alias("node"), v.alias("component")).union(
        now.select(v.alias("node"), v.alias("component")).distinct())
