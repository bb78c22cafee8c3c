"""Streams: two triggers equal the batch result; a replayed batch changes nothing."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.plans import feeds
from tidemark.plans.job import Context
from tidemark.sources.envelopes import wrap, write_envelopes
from tidemark.streaming import jobs as J
from tidemark.tables import files


def land_weather(spark, raw, place, n):
    rows = spark.range(n).select(F.array(F.struct(
        F.lit("l").alias("location"), F.lit(place).alias("location_name"), F.col("id").alias("time_from"))).alias("d"))
    write_envelopes(wrap(rows, F.col("d"), F.lit(1)), raw)


def forget_commit(spark, checkpoint, batch_id):
    for name in (f"{batch_id}", f".{batch_id}.crc"):
        files.remove(spark, f"{checkpoint}/commits/{name}")


def test_ingest_two_triggers_and_replay(spark, store, folder):
    raw, checkpoint, told = folder("raw"), folder("cp"), []
    context = Context(spark, store=store)
    run = lambda cp: J.ingest_process(spark, raw, feeds.weather, context, cp, updated=lambda n, b: told.append((n, b)))
    land_weather(spark, raw, "a", 5)
    run(checkpoint)
    land_weather(spark, raw, "b", 7)
    run(checkpoint)
    run(checkpoint)
    assert store.read("yr_weather").count() == 12
    assert told == [(["yr_weather"], 0), (["yr_weather"], 1)]
    # The last batch was written but its delivery record is lost: it is replayed and adds nothing.
    forget_commit(spark, checkpoint, 1)
    run(checkpoint)
    assert told[2:] == [(["yr_weather"], 1)]
    assert store.read("yr_weather").count() == 12
    # New files after the replay are still taken.
    land_weather(spark, raw, "a", 2)
    run(checkpoint)
    assert store.read("yr_weather").count() == 14


def test_dedupe_replay(spark, folder):
    feed, target, checkpoint = folder("feed"), folder("target"), folder("cp")
    rows = spark.range(30).select((F.col("id") % 10).alias("k"), "id")
    run = lambda cp: J.dedupe_existing(spark.readStream.schema(rows.schema).parquet(feed), ["k"], target, cp)
    for part in (rows.filter("k < 4"), rows):
        part.write.mode("append").parquet(feed)
        run(checkpoint)
    assert sorted(r["k"] for r in J.read_batches(spark, target).collect()) == list(range(10))
    forget_commit(spark, checkpoint, 1)
    run(checkpoint)
    assert sorted(r["k"] for r in J.read_batches(spark, target).collect()) == list(range(10))
    # Another stream into the same target adds only new keys and overwrites no batch.
    spark.createDataFrame([(99, 1)], "k BIGINT, id BIGINT").write.mode("append").parquet(feed)
    run(folder("cp"))
    assert sorted(r["k"] for r in J.read_batches(spark, target).collect()) == [*range(10), 99]


def test_dedupe_reads_the_target_once(spark, folder, monkeypatch):
    feed, target, checkpoint = folder("feed"), folder("target"), folder("cp")
    schema = "k STRING, v DOUBLE, r STRUCT<a: INT, b: STRING>"
    land = lambda rows: spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(feed)
    run = lambda: J.dedupe_existing(spark.readStream.schema(schema).parquet(feed), ["k"], target, checkpoint)
    land([("a", 2.0, (1, "x")), ("a", 1.0, None), ("a", 1.0, (0, None)), (None, float("nan"), (1, "y")), (None, 5.0, (2, "z"))])
    run()
    want = {("a", 1.0, None), (None, 5.0, (2, "z"))}
    assert {tuple(r) for r in J.read_batches(spark, target).collect()} == want

    def forbidden(*_):
        raise AssertionError("the target is read")

    monkeypatch.setattr(J, "earlier_batches", forbidden)
    land([("a", 0.0, None), (None, 0.0, None), ("b", 7.0, None)] + [("hot", float(i), None) for i in range(5000, 0, -1)])
    progress = run()
    assert sum(p["numInputRows"] for p in progress) == 5003
    assert {tuple(r) for r in J.read_batches(spark, target).collect()} == want | {("b", 7.0, None), ("hot", 1.0, None)}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_rows_of_a_key_are_combined_in_their_task(spark, monkeypatch):
    from tidemark.streaming import state
    monkeypatch.setattr(state, "HELD", 3)
    nested = spark.createDataFrame([(i % 7, str(i), [i]) for i in range(700)], "k INT, v STRING, l ARRAY<INT>").repartition(1)
    assert sum(r[state.ROWS] for r in state.smallest_in_task(nested, ["k"]).collect()) == 700
    df = spark.createDataFrame([(i % 7, str(i)) for i in range(700)], "k INT, v STRING").repartition(1)
    out = state.smallest_in_task(df, ["k"]).collect()
    assert len(out) == 7
    assert sum(r[state.ROWS] for r in out) == 700
    best = {}
    for r in out:
        best[r.k] = min(best.get(r.k, r.v), r.v)
    assert best == {k: min(str(i) for i in range(k, 700, 7)) for k in range(7)}


def test_one_row_of_a_key_is_left_in_a_partition(spark, monkeypatch):
    from tidemark.streaming import state
    monkeypatch.setattr(state, "HELD", 5)
    plain = spark.createDataFrame([(i % 50, str(i)) for i in range(3000)], "k INT, v STRING").repartition(3, "k")
    nested = plain.withColumn("l", F.array("v"))
    for df in (plain, nested, plain.withColumn("never", F.lit(1))):
        got = {r.k: r.v for r in state.smallest_in_partition(df, ["k"]).collect()}
        assert state.smallest_in_partition(df, ["k"]).count() == 50
        assert got == {k: min(str(i) for i in range(k, 3000, 50)) for k in range(50)}


def test_both_ways_of_combining_agree():
    import random

    import pyarrow as pa

    from tidemark.streaming import state
    rng = random.Random(3)
    rows = [{"k": rng.choice([None, "a", "b", "é"]), "n": rng.choice([None, 1, 2]), "v": rng.choice([None, 0.5, -1.0, 3.0]), "t": rng.choice([None, True, False])}
            for _ in range(500)]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.string()), ("n", pa.int32()), ("v", pa.float64()), ("t", pa.bool_())]))
    columns = batch.schema.names
    got = {(r["k"], r["n"]): r for r in state._smallest(batch, ["k", "n"], columns).to_pylist()}
    for key in {(r["k"], r["n"]) for r in rows}:
        mine = [r for r in rows if (r["k"], r["n"]) == key]
        best = min(mine, key=lambda r: [state.ordered(r[c]) for c in columns])
        assert got[key] == {**best, state.ROWS: len(mine)}
    assert not state._plain(pa.array([1.0, float("nan")])) and not state._plain(pa.array([[1]])) and state._plain(pa.array([], pa.float64()))


def late_stream(spark, folder):
    feed, target, aside, checkpoint = folder("feed"), folder("target"), folder("aside"), folder("cp")
    schema = "p STRING, v STRING, ends TIMESTAMP, ok BOOLEAN"
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    land = lambda rows: spark.createDataFrame([(p, v, None if n is None else day(n), ok) for p, v, n, ok in rows], schema).write.mode("append").parquet(feed)
    run = lambda to=target, cp=checkpoint: J.late_periods(
        spark.readStream.schema(schema).parquet(feed), "p", "ends", to, aside, cp, "28 days", F.col("ok"))
    stored = lambda to=target: {r.p: r.v for r in J.read_batches(spark, to).collect()}
    late = lambda: sorted((r.p, r.late) for r in J.read_batches(spark, aside).collect())
    return checkpoint, target, land, run, stored, late


def test_a_period_is_stored_once_when_it_is_closed(spark, folder):
    checkpoint, target, land, run, stored, late = late_stream(spark, folder)
    land([("w1", "b", 7, True), ("w1", "c", 7, True), ("w1", "a", 7, False), ("w1", "0", 7, None), ("w2", "x", 14, True), ("none", "v", None, True)])
    run()
    assert stored() == {}
    land([("w1", "bb", 7, True), ("w5", "e", 35, False)])  # closes w1 at day 35; rows that do not count move the time on as well
    run()
    assert stored() == {"w1": "b"} and late() == []
    land([("w1", "0", 7, True), ("w1", "00", 7, True), ("w2", "w", 14, True), ("w0", "old", 0, True), ("w9", "z", 63, True)])
    run()
    assert stored() == {"w1": "b", "w2": "w", "w0": "old"} and late() == [("w1", 2)]
    forget_commit(spark, checkpoint, max(int(c) for c in files.children(spark, f"{checkpoint}/commits") if c.isdecimal()))
    run()
    assert stored() == {"w1": "b", "w2": "w", "w0": "old"} and late() == [("w1", 2)]


def test_periods_of_another_stream_stay(spark, folder):
    checkpoint, target, land, run, stored, late = late_stream(spark, folder)
    land([("w1", "b", 7, True), ("w8", "e", 56, True)])
    run()
    assert stored() == {"w1": "b"}
    land([("w1", "a", 7, True), ("w2", "c", 14, True)])
    run(cp=folder("cp2"))  # reads the whole feed anew
    assert stored() == {"w1": "b", "w2": "c"} and late() == [("w1", 2)]


def test_signed_split_and_replay(spark, folder):
    from tidemark.functions import signature as S
    feed, good, bad, checkpoint = folder("feed"), folder("good"), folder("bad"), folder("cp")
    rows = spark.range(6).select(F.col("id").cast("string").alias("body"), F.lit("9").alias("timestamp"))
    rows = rows.withColumn("signature", F.when(F.col("body") < "4", S.chat_signature("timestamp", "body", "key")))
    rows.write.parquet(feed)
    run = lambda: J.split_signed(J.signed(spark.readStream.schema(rows.schema).parquet(feed), "key"), good, bad, checkpoint)
    run()
    forget_commit(spark, checkpoint, 0)
    run()
    assert J.read_batches(spark, good).count() == 4 and J.read_batches(spark, bad).count() == 2


def test_emoji_stream_equals_batch(spark, folder):
    from tidemark.sources.webhooks import CHAT_BODY, emoji_rows
    body = json.dumps({"team_id": "T", "event_time": 1, "event": {"type": "reaction_added", "reaction": "r", "item": {"channel": "C"}}})
    feed, target, checkpoint = folder("feed"), folder("target"), folder("cp")
    df = spark.createDataFrame([(body,)] * 3, "body STRING")
    for _ in range(2):
        df.write.mode("append").parquet(feed)
        J.append(J.emoji_events(spark.readStream.schema(df.schema).parquet(feed), "body"), target, checkpoint)
    batch = emoji_rows(spark.read.parquet(feed).select(F.from_json("body", CHAT_BODY).alias("b")))
    assert spark.read.parquet(target).count() == batch.count() == 6
