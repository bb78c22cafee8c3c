"""Views kept up to date from additions: equal to the full run, reading only what was added."""

import pytest
from pyspark.sql import functions as F

from tidemark.tables import views as V

VIEW = V.View("v", "t", ("k",), {
    "n": ("count", "x"), "total": ("sum", "x"), "low": ("min", "x"), "high": ("max", "x"), "mean": ("average", "x"),
    "kinds": ("distinct", "x"), "middle": ("median", "x")})


def batch(spark, seed, rows=400):
    k = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).alias("k")
    return spark.range(rows).select(k, F.when(F.col("id") % 11 != 0, (F.col("id") * 37 + seed) % 101).alias("x"))


def full(df):
    return df.groupBy("k").agg(F.count("x").alias("n"), F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high"),
                               F.avg("x").alias("mean"), F.count_distinct("x").alias("kinds"))


def test_equals_the_full_run_after_every_landing(spark, store, rows_of):
    for n in range(3):
        store.write(batch(spark, n), "t")
        assert V.refresh(store, VIEW) == {"writes": 1, "full": n == 0}
        assert V.refresh(store, VIEW) == {"writes": 0, "full": False}
        assert rows_of(V.read(store, VIEW).drop("middle")) == rows_of(full(store.read("t")))


def test_only_new_writes_are_read(spark, store, monkeypatch):
    store.write(batch(spark, 1, 5000), "t")
    V.refresh(store, VIEW)
    store.write(batch(spark, 2, 10), "t")
    read, real = [], store.read_folders
    monkeypatch.setattr(store, "read_folders", lambda folders: read.append(folders) or real(folders))
    V.refresh(store, VIEW)
    assert [f for group in read for f in group if "/structured/t/" in f] == store.folders("t")[-1:]


def test_replaced_rows_start_anew(spark, store, rows_of):
    for n in range(2):
        store.write(batch(spark, n), "t")
    V.refresh(store, VIEW)
    store.write(batch(spark, 9), "t", overwrite=True)
    assert V.refresh(store, VIEW) == {"writes": 1, "full": True}
    assert rows_of(V.read(store, VIEW).drop("middle")) == rows_of(full(store.read("t")))
    # another definition of the view starts anew as well
    other = V.View("v", "t", (), {"n": ("count", "x")})
    assert V.refresh(store, other)["full"] and V.read(store, other).first()["n"] == store.read("t").filter("x IS NOT NULL").count()


def test_a_changed_fixed_table_starts_anew(spark, store):
    store.write(spark.createDataFrame([(0, "a"), (1, "b")], "k LONG, name STRING"), "names")
    view = V.View("named", "t", ("name",), {"n": ("count", "k")}, lambda delta, read: delta.join(read("names"), "k"), ("names",))
    for n in range(2):
        store.write(batch(spark, n), "t")
        V.refresh(store, view)
    before = {r["name"]: r["n"] for r in V.read(store, view).collect()}
    store.write(spark.createDataFrame([(0, "c"), (1, "b")], "k LONG, name STRING"), "names", overwrite=True)
    assert V.refresh(store, view) == {"writes": 2, "full": True}
    assert {r["name"]: r["n"] for r in V.read(store, view).collect()} == {"c": before["a"], "b": before["b"]}


def test_two_refreshes_at_once_take_in_a_write_once(spark, store, monkeypatch):
    from tidemark.tables.commits import Commits
    store.write(batch(spark, 1), "t")
    V.refresh(store, VIEW)
    store.write(batch(spark, 2), "t")
    real, done = Commits.commit, []

    def interrupted(self, version):
        if not done:
            done.append(True)
            V.refresh(store, VIEW)
        return real(self, version)

    monkeypatch.setattr(Commits, "commit", interrupted)
    assert V.refresh(store, VIEW) == {"writes": 0, "full": False}
    assert sum(r["n"] for r in V.read(store, VIEW).collect()) == store.read("t").filter("x IS NOT NULL").count()


def test_empty(spark, store):
    assert V.refresh(store, VIEW) == {"writes": 0, "full": False}
    with pytest.raises(FileNotFoundError):
        V.read(store, VIEW)


@pytest.mark.parametrize("parts", [1, 12])
def test_sketch_errors_are_within_their_bounds(spark, store, parts):
    """200,000 values in `parts` landings: distinct within 5 % (three standard errors), the median within a rank of 1.4 %."""
    view = V.View("s", "big", (), {"kinds": ("distinct", "x"), "middle": ("median", "x")})
    rows = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(60_000)).alias("x"), (F.col("id") % parts).alias("p"))
    for p in range(parts):
        store.write(rows.filter(F.col("p") == p), "big")
        V.refresh(store, view)
    got, exact = V.read(store, view).first(), rows.agg(F.count_distinct("x")).first()[0]
    assert abs(got["kinds"] - exact) <= 0.05 * exact
    below, upto = rows.agg(F.avg((F.col("x") < got["middle"]).cast("int")), F.avg((F.col("x") <= got["middle"]).cast("int"))).first()
    assert below <= 0.514 and upto >= 0.486
