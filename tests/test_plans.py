"""Plans: pushdown, pruning, and nothing that does not scale."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import new_folder
from tidemark.queries.registry import GROUPS, QUERIES

FOLDER = "/root/testdata/sf0.001"
PLANNED = [n for n in sorted(QUERIES) if GROUPS[n] in ("cleansing", "joins", "aggregates", "windows", "scalars", "reports",
                                                       "deployments")]
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not [word for word in FORBIDDEN if word in text]


def test_report_filters_reach_the_scan(spark, store):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("s"), F.lit(1).alias("unused"))
    store.materialize("r", df, 1)
    text = plan(store.cached_report("r", 1, {"id": 3, "s": "3"}).select("id"))
    assert "EqualTo(id,3)" in text and "EqualTo(s,3)" in text
    assert "unused" not in text


def test_partition_filters_prune(spark, store):
    store.write(spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("p")), "t", ["p"])
    assert "PartitionFilters: [isnotnull(p" in plan(store.read("t").filter("p = '1'"))


def test_only_used_columns_are_read(spark):
    text = plan(QUERIES["group_avg"](spark, FOLDER))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in text


def test_filter_is_pushed(spark):
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.0)]" in plan(QUERIES["filter_positive"](spark, FOLDER))


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(QUERIES["group_by_dedupe"](spark, FOLDER))
    assert text.count("HashAggregate") == 2


def test_competence_reports_read_the_answers_little(spark):
    """Counts of topics and categories come from one read of the answers; averages beside the answers from two."""
    from tidemark.plans import reports as R
    answers = spark.range(50).selectExpr("'n' as username", "concat('c', id % 5) as email", "concat('q', id % 4) as questionid", "double(id % 6) as knowledge",
                                         "double(id % 5) as motivation")
    path = new_folder(spark, "answers")
    answers.write.parquet(path)
    answers = spark.read.parquet(path)
    questions = spark.createDataFrame([(f"q{i}", f"t{i}", "knowledgeMotivation" if i else "x", "c1") for i in range(4)], "id string, topic string, type string, categoryid string")
    categories = spark.createDataFrame([("c1", "Cat")], "id string, text string")
    for build, most in ((R.comp_amount, 1), (R.employee_mot_comp, 2)):
        for rated_only in (False, True):
            plan = build(answers, questions, categories, rated_only=rated_only)._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("] parquet") <= most, plan
