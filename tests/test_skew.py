"""Hot groups: exact results, and plans that can split them."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import windows as W


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, many of them copies of one row."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 6 == 0, 7).otherwise((F.col("id") * 37) % 101).alias("v"),
        F.when(F.col("id") % 6 == 0, 1).otherwise(F.col("id")).alias("t"))
    return df.repartition(6)


def test_rank_rows_large_groups(spark, hot, rows_of):
    want = hot.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc(), "t")).cast("long"))
    got = W.rank_rows(hot, ["k"], [F.col("v").desc(), F.col("t")], "n")
    assert rows_of(got.select("k", "v", "t", "n")) == rows_of(want.select("k", "v", "t", "n"))


def test_rank_rows_numbers_are_whole(hot):
    got = W.weight_rank(hot, "k", "v", ["t"])
    check = got.groupBy("k").agg(F.count("*").alias("c"), F.min("weigth").alias("a"), F.max("weigth").alias("b"),
                                 F.count_distinct("weigth").alias("d"))
    assert check.filter("a <> 1 OR b <> c OR d <> c").isEmpty()


@pytest.mark.parametrize("slices", ["1", "3", "50"])
def test_rank_rows_any_number_of_slices(spark, rows_of, slices):
    """Null and NaN keys, groups over many slices, slices without rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        nan = float("nan")
        data = [(k, q, i % 40) for i in range(300) for k, q in [(None, 1.0), ("a", nan), ("a", None), ("b", 2.0)][:1 + i % 4]]
        df = spark.createDataFrame(data, "k STRING, q DOUBLE, v INT").repartition(5)
        got = W.rank_rows(df, ["k", "q"], [F.col("v").desc()], "n")
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "q").orderBy(F.col("v").desc())).cast("long"))
        assert repr(rows_of(got)) == repr(rows_of(want))
        assert W.rank_rows(df.limit(0), ["k"], [F.col("v")], "n").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rank_rows_runs_nothing_while_it_is_planned(spark, hot):
    context = spark.sparkContext
    context.setJobGroup("planning ranks", "")
    try:
        ranked = W.weight_rank(hot, "k", "v", ["t"])
        ranked.explain("simple")
        assert not context.statusTracker().getJobIdsForGroup("planning ranks")
        assert ranked.count() == 9000
        assert context.statusTracker().getJobIdsForGroup("planning ranks")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_rank_rows_spreads_a_hot_group(spark, hot):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        one = hot.withColumn("k", F.lit(1))
        parts = W.rank_rows(one, ["k"], [F.col("v")], "n").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 2 and sum(r["count"] for r in parts) == 9000
        slices = W.rank_rows(one, ["k"], [F.col("v")], "n")._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in slices and "hashpartitioning(_slice" in slices
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def splitting(spark):
    """Settings under which a small hot key counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_splits_a_hot_key(splitting, hot):
    side = hot.groupBy("k").agg(F.avg("v").alias("mean"))
    assert "skew=true" in final_plan(J.lookup_join(hot, side, ["k"]))
    # The plain join on the same key cannot: this is why lookup_join exists.
    assert "skew=true" not in final_plan(hot.join(side, "k"))


def test_left_join_splits_a_hot_right_side(splitting, spark, hot):
    people = spark.range(600).select(F.col("id").alias("k"), F.lit("p").alias("name"))
    assert "skew=true" in final_plan(J.left_join(people, hot, ["k"]))


def test_latest_splits_ties(splitting, hot):
    assert "skew=true" in final_plan(W.latest(hot.withColumn("t", F.lit(1)), ["k"], "t"))


def test_left_join_equals_outer_join(spark, hot, rows_of):
    people = spark.range(700).select(F.col("id").alias("k"), F.lit("p").alias("name"))
    want = people.join(hot, "k", "left").select("k", "name", "v", "t")
    assert rows_of(J.left_join(people, hot, ["k"]).select("k", "name", "v", "t")) == rows_of(want)


def test_left_join_without_partners(spark, rows_of):
    """Everything without a partner, two keys, and columns of one name on both sides' keys only."""
    left = spark.createDataFrame([(i, None if i % 3 else "x", {"m": i}) for i in range(300)], "k INT, p STRING, m MAP<STRING, INT>").repartition(7)
    right = spark.createDataFrame([(5, "x", 1.0), (6, "x", 2.0), (6, "x", 3.0), (None, None, 4.0)], "k INT, p STRING, w DOUBLE")
    got = J.left_join(left, right, ["k", "p"]).select("k", "p", "w", F.col("m")["m"].alias("m"))
    assert rows_of(got) == rows_of(left.join(right, ["k", "p"], "left").select("k", "p", "w", F.col("m")["m"].alias("m")))
    assert J.left_join(left, right.limit(0), ["k", "p"]).count() == 300


def test_lookup_join_null_keys_match_nothing(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k STRING, v INT")
    side = spark.createDataFrame([(None, "x"), ("a", "y")], "k STRING, w STRING")
    assert [tuple(r) for r in J.lookup_join(df, side, ["k"]).collect()] == [("a", 2, "y")]
    assert J.lookup_join(df, side, ["k"], "left").filter("k IS NULL").head()["w"] is None


def test_latest_keeps_ties(spark, rows_of):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n")], "k STRING, t INT, v STRING")
    assert rows_of(W.latest(df, ["k"], "t")) == [("a", 2, "y"), ("a", 2, "z")]


def test_top_periods_equals_rank(hot, rows_of):
    df = hot.select("k", (F.col("v") % 9).alias("p"), "t")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("p").desc()))).filter("r <= 5").drop("r")
    assert rows_of(W.top_periods(df, ["k"], "p", 5)) == rows_of(want)


def test_unmatched_full_equals_full_join(spark, rows_of):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id INT, boss STRING")
    right = spark.createDataFrame([("a", "x"), (None, "y"), ("", "z"), ("q", "w")], "name STRING, mail STRING")
    want = left.join(right, left["boss"] == right["name"], "full").filter("name IS NULL OR name = ''")
    got = J.unmatched_full(left, right, "boss", "name").select(*want.columns)
    assert rows_of(got) == rows_of(want)


def test_dedupe_limits_before_the_shuffle(hot):
    plan = W.dedupe_keep_last(hot, ["k"], ["t", "v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_project_rollup_counts_people_over_all_periods(spark, rows_of):
    df = spark.createDataFrame(
        [("c", "w", "p1", "a", 1.0), ("c", "w", "p1", "b", 2.0), ("c", "w", "p2", "a", 4.0), ("d", "w", "p1", "a", 8.0)],
        "customer STRING, work_order_description STRING, reg_period STRING, alias STRING, used_hrs DOUBLE")
    got = A.project_rollup(df, 9).select("customer", "reg_period", "employees", "hours")
    assert rows_of(got) == [("c", "p1", 2, 3.0), ("c", "p2", 2, 4.0), ("d", "p1", 1, 8.0)]


def test_left_join_splits_when_the_left_side_is_partitioned(splitting, spark, hot):
    people = spark.range(600).select(F.col("id").alias("k"), F.lit("p").alias("name"))
    more = spark.range(600).select(F.col("id").alias("k"), F.lit("m").alias("more"))
    assert "skew=true" in final_plan(J.left_join(people.join(more, "k", "left"), hot, ["k"]))


def test_left_join_keeps_null_keys(spark, rows_of):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k STRING, v INT")
    right = spark.createDataFrame([(None, "x"), ("a", "y"), ("a", "z")], "k STRING, w STRING")
    assert rows_of(J.left_join(left, right, ["k"])) == rows_of(left.join(right, "k", "left"))


def test_resolve_person_splits_a_hot_alias(splitting, spark, hot):
    rows = hot.withColumn("alias", F.concat(F.lit("a"), F.col("k").cast("string")))
    people = spark.range(600).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("alias"),
                                     F.col("id").cast("string").alias("guid"))
    assert "skew=true" in final_plan(J.resolve_person(rows, people, "alias"))
