"""Raw envelopes: one JSON object per ingest, `metadata` plus a source-specific `data` payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("event", T.StringType()),
    T.StructField("event_type", T.StringType()),
])


def envelope_schema(payload: T.DataType | str) -> T.StructType:
    if isinstance(payload, str):
        payload = T._parse_datatype_string(payload)
    return T.StructType([T.StructField("metadata", METADATA), T.StructField("data", payload)])


def read_envelopes(spark: SparkSession, path: str, payload: T.DataType | str, stream: bool = False,
                   **options) -> DataFrame:
    """Landed envelopes with a typed payload.

    Some sources land one object per webhook and a list per poll. For a payload that is an
    array of structs the payload is parsed from its JSON text, where both forms are accepted.

    Nothing is lost silently: a broken line or a value of a wrong type fails the read, unless another `mode` is given.
    """
    kind = T._parse_datatype_string(payload) if isinstance(payload, str) else payload
    mode = options.setdefault("mode", "FAILFAST")
    reader = (spark.readStream if stream else spark.read).options(**options)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        raw = reader.schema(envelope_schema(T.StringType())).json(path)
        return raw.select("metadata", F.from_json("data", kind, {"mode": mode}).alias("data"))
    return reader.schema(envelope_schema(kind)).json(path)


def write_envelopes(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Land envelopes under the raw folder; `overwrite` empties it first."""
    df.select("metadata", "data").write.mode("overwrite" if overwrite else "append").json(path)


def wrap(df: DataFrame, data, timestamp, event_type=None) -> DataFrame:
    """Envelopes from columns."""
    return df.select(
        F.struct(timestamp.cast("double").alias("timestamp"), F.lit(None).cast("string").alias("event"),
                 (event_type if event_type is not None else F.lit(None).cast("string")).alias("event_type"))
        .alias("metadata"), data.alias("data"))


def with_meta_time(df: DataFrame, as_float: bool = False) -> DataFrame:
    """Payload records as rows, with the envelope time as `time`.

    A list payload gives one row per element, an object payload one row.
    """
    time = F.col("metadata.timestamp") if as_float else F.col("metadata.timestamp").cast("long")
    if isinstance(df.schema["data"].dataType, T.ArrayType):
        # Of a bare column Spark first asks the size, in a filter pushed below what makes it: the payload would be computed twice.
        return df.select(F.inline(F.slice("data", 1, F.size("data"))), F.col("metadata")).select(
            "*", time.alias("time")).drop("metadata")
    return df.select("data.*", time.alias("time"))


def union_pages(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All landed pages of one listing as one record set."""
    return spark.read.schema(schema).json(paths)
