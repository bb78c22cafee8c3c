"""Directory states after each maintenance rule."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.tables import files
from tidemark.tables.commits import Commits
from tidemark.tables.store import database_name, level_database, verify_schema


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, 1), (2, None)], "a BIGINT, b BIGINT")


def data(store, name):
    """The files of the newest version."""
    return [f"{d}/{f}" for d in store.folders(name) for f in files.data_files(store.spark, d) if f.endswith(".parquet")]


def test_new_table_is_gzip_parquet(store, frame):
    assert store.write(frame, "t") == "t"
    assert all(".gz." in f for f in data(store, "t"))
    assert store.read("t").count() == 2


def test_append_keeps_old_files(store, frame):
    store.write(frame, "t")
    before = set(data(store, "t"))
    store.write(frame, "t")
    assert before < set(data(store, "t"))
    assert store.read("t").count() == 4
    assert store.archived("t") == []


def test_overwrite_drops_old_files(store, frame):
    store.write(frame, "t")
    before = set(data(store, "t"))
    store.write(frame, "t", overwrite=True)
    assert not before & set(data(store, "t"))
    assert store.read("t").count() == 2


def test_null_partitions_get_names(store, spark, rows_of):
    df = spark.createDataFrame([(1, None, None), (2, 5, "x")], "a INT, b INT, c STRING")
    store.write(df, "t", ["b", "c"])
    assert store.partitions("t") == ["b", "c"]
    assert rows_of(store.read("t").select("a", "b", "c")) == [(1, "-1", "undefined"), (2, "5", "x")]
    assert {"b=-1", "b=5"} <= set(files.children(spark, store.folders("t")[0]))


def test_partition_text_survives(store, spark):
    store.write(spark.createDataFrame([(1, "007"), (2, "org/repo")], "a INT, b STRING"), "t", ["b"])
    assert sorted(r["b"] for r in store.read("t").collect()) == ["007", "org/repo"]


@pytest.mark.parametrize("change, partitions", [
    (lambda d: d.withColumn("c", F.lit(1)), []),
    (lambda d: d.drop("b"), []),
    (lambda d: d.withColumnRenamed("b", "c"), []),
    (lambda d: d.withColumn("b", F.col("b").cast("double")), []),
    (lambda d: d, ["b"]),
])
def test_schema_change_archives(store, frame, change, partitions):
    store.write(frame, "t")
    store.write(change(frame), "t", partitions)
    kept = store.archived("t")
    assert len(kept) == 1
    assert store.read_archived("t", kept[0]).schema == frame.schema
    assert sorted(r["a"] for r in store.read_archived("t", kept[0]).collect()) == [1, 2]
    assert store.read("t").count() == 2


@pytest.mark.parametrize("first, second, same", [
    (["a"], ["a"], True), (["a"], ["b"], False), (["a"], [], False), ([], ["a"], False), (["a", "b"], ["b", "a"], True),
    (["a", "b"], ["a"], False), (["a"], ["a", "b"], False),
])
def test_verify_schema_partitions(frame, first, second, same):
    wide = frame.withColumn("c", F.lit(1)).schema
    assert verify_schema(wide, first, wide, second) is same


def test_column_order_does_not_matter(store, frame):
    store.write(frame, "t")
    store.write(frame.select("b", "a"), "t")
    assert store.archived("t") == []
    assert store.read("t").count() == 4


def test_historical_table_appends_while_job_overwrites(store, frame):
    for _ in range(2):
        assert store.write_all({"t": frame, "h": frame}, {}, True, True, ("h",)) == ["t", "h"]
    assert store.read("t").count() == 2
    assert store.read("h").count() == 4


def test_purge_removes_archives_of_that_table_only(store, frame):
    for name in ("t", "u"):
        store.write(frame, name)
        store.write(frame.withColumn("c", F.lit(1)), name)
    store.write(frame.withColumn("c", F.lit(1)), "t", overwrite=True, purge_versions=True)
    assert store.archived("t") == []
    assert len(store.archived("u")) == 1


def test_purge_spares_historical(store, frame):
    store.write(frame, "h", historical=True)
    store.write(frame.withColumn("c", F.lit(1)), "h", overwrite=True, purge_versions=True, historical=True)
    assert len(store.archived("h")) == 1


def test_empty_and_missing_are_skipped(store, frame):
    store.write(frame, "t")
    assert store.write(frame.limit(0), "t", overwrite=True) is None
    assert store.write(None, "t", overwrite=True) is None
    assert store.write_all({"t": frame.filter("a < 0"), "u": None}) == []
    assert store.read("t").count() == 2
    assert not store.exists("u")


def test_wrong_return_type(store):
    with pytest.raises(TypeError):
        store.write_all({"t": [1, 2]})


def test_overwrite_may_read_the_same_table(store, frame):
    store.write(frame, "t")
    store.write(store.read("t").withColumn("a", F.col("a") * 10), "t", overwrite=True)
    assert sorted(r["a"] for r in store.read("t").collect()) == [10, 20]


def test_repeated_batch_changes_nothing(store, frame):
    store.write(frame, "t")
    for _ in range(2):
        assert store.write(frame, "t", batch="b1") == "t"
    assert store.read("t").count() == 4


def test_batch_broken_off_before_its_commit_is_finished(store, spark, monkeypatch):
    store.write(spark.range(10).repartition(3), "t")
    real = Commits.commit

    def failing(self, version):
        raise IOError("lost")

    monkeypatch.setattr(Commits, "commit", failing)
    with pytest.raises(IOError):
        store.write(spark.range(100, 130).repartition(3), "t", batch="b2")
    monkeypatch.setattr(Commits, "commit", real)
    assert store.read("t").count() == 10
    # The second attempt must not compute again: it gets other rows and still publishes the first.
    store.write(spark.range(500, 501), "t", batch="b2")
    assert sorted(r["id"] for r in store.read("t").collect()) == list(range(10)) + list(range(100, 130))


def test_batch_broken_off_while_writing_is_written_again(store, spark):
    store.write(spark.range(3), "t")
    folder = store.commits("t").new_write(spark.range(1).schema, [], "s-4")
    spark.range(50, 60).write.parquet(f"{store.path('t')}/{folder}")
    files.remove(spark, f"{store.path('t')}/{folder}/_SUCCESS")
    assert store.read("t").count() == 3
    store.write(spark.range(100, 101), "t", batch="s-4")
    assert sorted(r["id"] for r in store.read("t").collect()) == [0, 1, 2, 100]


def test_only_the_last_batch_of_a_stream_is_remembered(store, spark):
    for n in range(3):
        store.write(spark.range(n, n + 1), "t", batch=f"stream-{n}")
    store.write(spark.range(9), "t", batch="once")
    assert store.commits("t").latest().batches == {"stream": 2, "once": -1}
    for again in ("stream-0", "stream-2", "once"):
        store.write(spark.range(100), "t", batch=again)
    assert store.read("t").count() == 12


def test_many_files_are_one_commit(store, spark):
    store.write(spark.range(1), "t")
    before = store.commits("t").latest().number
    store.write(spark.range(50_000).repartition(1000), "t")
    assert store.commits("t").latest().number == before + 1
    assert len(data(store, "t")) > 1000 and store.read("t").count() == 50_001


def test_two_writers_lose_no_rows(store, spark, monkeypatch):
    """The second writer commits while the first is between reading the version and committing its own."""
    real, done = Commits.commit, []

    def interrupted(self, version):
        if not done:
            done.append(True)
            store.write(spark.range(100, 105), "t")
        return real(self, version)

    store.write(spark.range(5), "t")
    monkeypatch.setattr(Commits, "commit", interrupted)
    store.write(spark.range(50, 55), "t")
    assert sorted(r["id"] for r in store.read("t").collect()) == [*range(5), *range(50, 55), *range(100, 105)]
    # a writer with another schema archives the rows of both
    done.clear()
    store.write(spark.range(3).toDF("other"), "t")
    assert store.read("t").columns == ["other"]
    assert sum(store.read_archived("t", a).count() for a in store.archived("t")) == 20


def test_writers_in_parallel(store, spark):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: store.write(spark.range(n * 10, n * 10 + 10), "t"), range(12)))
    assert sorted(r["id"] for r in store.read("t").collect()) == list(range(120))
    assert store.commits("t").latest().number == 12


def test_readers_keep_the_version_they_took(store, spark):
    store.write(spark.range(10), "t")
    reader = store.read("t")
    store.write(spark.range(20), "t", overwrite=True)
    assert reader.count() == 10 and store.read("t").count() == 20
    store.write(spark.range(30), "t", overwrite=True)
    store.write(spark.range(40), "t", overwrite=True)
    assert len(files.children(spark, store.folders("t")[0].rpartition("/")[0])) == 2  # this version and the one before


def test_uncommitted_rows_are_not_seen(store, spark):
    store.write(spark.range(4), "t")
    spark.range(99).write.parquet(f"{store.path('t')}/{store.commits('t').new_write(spark.range(1).schema, [])}")
    database = level_database("half" + store.root[-6:], 1)
    store.register("t", database)
    assert store.read("t").count() == spark.table(f"{database}.t").count() == 4


def test_partition_order_of_the_table_stays(store, spark):
    df = spark.createDataFrame([(1, "x", "y")], "a INT, b STRING, c STRING")
    store.write(df, "t", ["b", "c"])
    store.write(df, "t", ["c", "b"])
    assert store.partitions("t") == ["b", "c"] and store.read("t").count() == 2


def test_archive_by_hand(store, frame):
    store.write(frame, "t")
    time = store.archive("t")
    assert not store.exists("t") and store.read_or_none("t") is None
    assert store.read_archived("t", time).count() == 2
    store.write(frame, "t")
    assert store.read("t").count() == 2 and store.archived("t") == [time]


def test_register(store, frame, spark):
    store.write(frame.withColumn("p", F.lit("x")), "t", ["p"])
    database = level_database("unit" + store.root[-6:], 3)
    assert store.register("t", database) is True
    assert store.register("t", database) is False
    assert spark.table(f"{database}.t").filter("p = 'x'").count() == 2


def test_database_names():
    assert level_database("dev", 2) == "dev_level_2_database"
    assert database_name("level_1", "dev") == "dev_level_1_database"
    assert database_name("dev_level_1_database", "dev") == "dev_level_1_database"
    assert database_name(None, "dev") is None


def test_report_lifecycle(store, frame):
    store.materialize("r", frame, 2)
    store.materialize("r", frame.limit(1), 2)
    assert store.cached_report("r", 2).count() == 1
    store.drop_materialized("r", 2)
    assert not files.exists(store.spark, store.report_path("r", 2))


def test_shuffles_widen_with_the_input(spark):
    from tidemark.session import size_shuffles
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 1000) == 4
        assert size_shuffles(spark, 100 * 1024 ** 3) == 3201
        assert spark.conf.get(setting) == "3201"
        assert size_shuffles(spark, 1000) == 3201
        assert size_shuffles(spark, 10 ** 15) == 10 ** 15 * 4 // (128 * 1024 ** 2) + 1
    finally:
        spark.conf.unset(setting)


def test_old_manifests_go_and_the_table_stays(store, spark, monkeypatch):
    from tidemark.tables import commits
    monkeypatch.setattr(commits, "KEPT_SECONDS", -1)
    log = store.commits("t")
    store.write(spark.range(7), "t")
    for _ in range(205):
        now = log.latest()
        assert log.commit(commits.replace(now, number=now.number + 1))
    assert log.latest().number == 206 and len(log._numbers()) < 150
    assert not log.commit(commits.replace(now, number=206))
    assert store.read("t").count() == 7
