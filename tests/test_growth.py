"""Steps that have to grow no faster than their input: right rows, and plans without the costly step."""

import random
import time

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import windows as W
from tidemark.plans import catalogue, people
from tidemark.plans import reports as R
from tidemark.plans.registry import refresh, stored_sql
from tidemark.queries import governance, roles
from tidemark.queries.registry import Tables
from tidemark.session import shuffles_removed
from tidemark.sources import documents as docs
from tidemark.sources.envelopes import with_meta_time, wrap


def test_newest_periods(spark, rows_of):
    df = spark.createDataFrame([("a", p) for p in ("1", "3", "3", "2", "5")] + [("b", "4"), (None, "1")], "k STRING, p STRING")
    assert rows_of(W.newest_periods(df, "k", "p", 2)) == [("a", "3"), ("b", "4"), (None, "1")]


def all_projects(rows):
    """The report without a mapping, from its definition."""
    known = [r for r in rows if r[0] is not None and r[1] is not None]
    stamps = lambda key: {k: max(r[3] for r in rows if r[3] is not None and key(r) == k) for k in {key(r) for r in rows if r[3] is not None}}
    newest, own = stamps(lambda r: (r[0], r[2])), stamps(lambda r: r[:3])
    current = [r for r in known if r[2] is not None and r[3] is not None and r[3] == own[r[:3]]]
    out = {}
    for c, w in {r[:2] for r in known}:
        billed = {}
        for r in current:
            if r[:2] == (c, w) and r[3] == newest[c, r[2]]:
                billed[r[5]] = billed.get(r[5], 0) + r[4]
        periods = [r[2] for r in known if r[:2] == (c, w) and r[2] is not None]
        last = {r[4] for r in known if r[:2] == (c, w) and periods and r[2] == max(periods)}
        crew = [r[5] for r in current if r[:2] == (c, w) and sum(o[0] == c and o[2] > r[2] for o in current) < 5]
        for total in billed.values():
            for hours in last if crew else ():
                a, b, n = out.get(c, (0, 0, 0))
                out[c] = (a + total, b + hours, n + max(crew))
    return sorted(((c, *v) for c, v in out.items()), key=repr)


def test_all_projects_from_its_definition(spark, rows_of):
    pick = random.Random(5)
    rows = [(pick.choice(["x", "y", "z", None]), pick.choice(["v", "w", None]), pick.choice([*"123456789", None]), pick.choice([100, 200, 300, None]),
             float(pick.randint(1, 9)), pick.randint(1, 4)) for _ in range(160)]
    rows += [("one", "v", "1", 100, 2.0, 3), ("one", None, "2", 200, 2.0, 3)] + [rows[0]] * 3
    projects = spark.createDataFrame(rows, "customer STRING, work_order STRING, reg_period STRING, timestamp LONG, hours DOUBLE, employees INT")
    mapping = spark.createDataFrame([], "`dagens ubw prosjekt` STRING, arbeids_ordre STRING, kunde STRING, prosjekt STRING")
    assert rows_of(R.all_projects(projects, mapping)) == all_projects(rows)


def test_projects_are_grouped_by_numbers(spark, tmp_path):
    """The texts of a project row are made once per group, not per order line."""
    class Tables:
        lineitem = spark.createDataFrame([(1, 2, 1, "N", 3.0), (1, 2, 1, "N", 4.0), (2, None, 1, "A", 5.0)],
                                         "l_orderkey LONG, l_suppkey LONG, l_linenumber INT, l_returnflag STRING, l_quantity DOUBLE")
        orders = spark.sql("SELECT 1L AS o_orderkey, 7L AS o_custkey, TIMESTAMP_NTZ '1998-02-06 00:00:00' AS o_orderdate UNION ALL SELECT 2L, 8L, NULL")
    Tables.spark = spark
    source = roles.Roles(Tables)
    assert sorted(map(tuple, source.projects.collect()), key=repr) == [("s2", "w1", "199802", 200, 7.0, 1), (None, "w1", None, 100, 5.0, 1)]
    plan = source.project_rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_suppkey" in plan


def test_merge_combines_by_hashing(spark, rows_of):
    kinds = "k STRING, q STRING, time LONG"
    new = spark.createDataFrame([("a", "1", 5), ("a", "1", 4), ("b", None, None), ("b", None, 3), ("c", "1", 9)], kinds)
    old = spark.createDataFrame([("a", "1", 1), ("b", None, 2), ("d", "1", 7), ("d", "1", None), ("e", None, 6), ("e", None, 8)], kinds)
    got = W.merge_new_with_old(new, old, ["time"])
    assert got.columns == ["k", "q", "time"]
    assert rows_of(got) == sorted([("a", "1", 4), ("b", None, None), ("c", "1", 9), ("d", "1", None), ("e", None, 6)], key=repr)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    texts = W.merge_new_with_old(*[df.withColumn("time", F.col("time").cast("string")) for df in (new, old)], ["time"])
    assert rows_of(texts.withColumn("time", F.col("time").cast("long"))) == rows_of(got)


def test_rollup_shuffles_rows_once_per_result(spark, rows_of):
    rows = [("c", "w", p, a, h) for p, a, h in [("1", "x", 2.0), ("1", "x", 3.0), ("1", "y", 1.0), ("2", None, 4.0), ("2", "y", None)]]
    df = spark.createDataFrame(rows, "customer STRING, work_order_description STRING, reg_period STRING, alias STRING, used_hrs DOUBLE")
    got = A.project_rollup(df, 7)
    assert rows_of(got) == [("c", 2, 4.0, "2", 7, "w"), ("c", 2, 6.0, "1", 7, "w")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [" in line and "reg_period" in line.split("]")[0] and "alias" in line.split("]")[0]]


def test_hours_are_typed_before_they_are_staged(spark):
    record = ("tab STRING, reg_period STRING, used_hrs STRING, resource_id STRING, xr1project STRING, work_order STRING, xwork_order STRING, "
              "xr0work_order STRING")
    one = lambda hrs, period="20241": ("B", period, hrs, "AL", "p", "o", "w", "c")
    env = spark.createDataFrame([((1.9, None, None), [one("5"), one("0"), one("NaN"), one("x"), one("5", None)])],
                                f"metadata STRUCT<timestamp DOUBLE, event STRING, event_type STRING>, data ARRAY<STRUCT<{record}>>")
    got = people.hours_per_resource.stage(env)
    assert [(r["alias"], r["used_hrs"], r["time"], r["_worked"]) for r in got.collect()] == [
        ("al", 5.0, 1, True), ("al", 0.0, 1, False), ("al", 0.0, 1, False), ("al", 0.0, 1, False), ("al", 5.0, 1, False)]


def forecasts():
    """Forecast documents: plain ones, some laid out differently, and some that are odd or broken."""
    step = lambda i, v="0.5", t="7", more="", inner="": (
        f'<time from="2024-01-{i % 28 + 1:02d}T{i % 24:02d}:00:00" to="2024-02-{i % 28 + 1:02d}T{i % 24:02d}:30:00"{more}>{inner}<precipitation value="{v}"/>'
        f'<windSpeed mps="{i}.25"/><temperature value="{t}"/><pressure value="{i}"/></time>')
    doc = lambda *steps, name="Oslo", before="", after="": (
        f"<weatherdata><location><name>{name}</name></location>{before}<forecast><tabular>{''.join(steps)}</tabular></forecast>{after}</weatherdata>")
    run = [step(i) for i in range(26)]
    plain = [
        doc(*run), doc(run[0]), doc(*run, name=" Ås &amp; by "), doc(*run, name="<![CDATA[a<time b]]>"), doc(*run[:3], name=""),
        '<?xml version="1.0"?>' + doc(*run[:5]), doc(*[s.replace("/><", "/>\n  <").replace("><p", ">\n <p").replace("/>", " />") + "\n" for s in run]),
        doc(*[step(i, more=f' period="{i}"', inner='<symbol number="3" name="Fair weather"/>') for i in range(30)]),
        doc(step(1, v="-1.5E-7", t="-3"), step(2, v="1.0E10", t="0")), doc(*run, before='<sun rise="1"/><!-- <time -->', after="<x>&lt;</x>"),
        doc(*run, before="<forecast><tabular><time/></tabular></forecast>")]
    turned = run[1].replace('<windSpeed mps="1.25"/>', "").replace("</time>", '<windSpeed mps="1.25"/></time>')
    odd = [
        doc(), None, "", "x", doc(*run)[:-3], doc(*run, turned), doc(run[0], step(1, v="null"), run[2]), doc(*run[:25], step(25, t="x")), doc(step(1, t="1.5")),
        doc(step(1, t="99999999999")), doc(step(1, v=" 1 ")), doc(step(1, v="+1")), doc(step(1, v="")), doc(step(1, v="1&#46;5")), doc(*run).replace('"', "'"),
        doc(run[0], "<!-- x -->", run[1]), doc(run[0], "text", run[1]), doc(run[0], run[1], "text"), doc(run[0], "5;6,7", run[1]), doc(run[0], "<other/>", run[1]),
        doc(run[0].replace('<pressure value="0"/>', "")), doc(run[0].replace("<pressure", "<Pressure")), doc(run[0].replace(" mps=", " Mps=")),
        doc(run[0].replace('<pressure value="0"/>', '<pressure value="0"/><pressure value="9"/>')), doc(run[0].replace('<pressure value="0"/>', '<pressure value="0"></pressure>')),
        doc(step(1, more=' a="1" a="2"')), doc(step(1, more=' a="1" b="2"')), doc(step(1, more=' From="2024-03-01T00:00:00"')), doc(step(1, inner='<Pressure value="4"/>')),
        doc(step(1, inner='<symbol a="1" a="1"/>')), doc(step(1, inner="<symbol>1</symbol>")), doc(*run, before="<!--", after="-->"), doc("<!--", *run, "-->"),
        doc("<![CDATA[", *run, "]]>"), doc(*run, after="<forecast><tabular/></forecast>"), doc(*run, after=f"<forecast><tabular>{run[3]}</tabular></forecast>"),
        f"<weatherdata><location><name>x</name></location><other>{run[0]}</other></weatherdata>", f"<a>{doc(*run)}</a>", doc('<time from="2024-01-01T00:00:00"/>'), doc("<time/>", *run),
        doc(*run, before="<p>"), doc("<p>", *run, "</p>"), doc(*run, name="a\x01b"), "<weatherdata>" + "".join(run) + "</weatherdata>"]
    return plain, odd


def test_forecast_texts_as_the_xml_reader_reads_them(spark, rows_of):
    plain, odd = forecasts()
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(plain + odd)], "k STRING, x STRING")
    parsed = df.select("k", F.from_xml("x", docs.FORECAST).alias("p")).select("k", "p.*")
    for first in (24, 2):
        expected = docs.forecast_rows(parsed, F.col("k"), first)
        got = docs.forecast_texts(df, F.col("x"), F.col("k"), first)
        assert got.schema.simpleString() == expected.schema.simpleString()
        assert rows_of(got) == rows_of(expected)
    assert {r[0] for r in rows_of(got)} >= {str(i) for i in range(len(plain))}


def test_plain_steps_are_not_read_as_elements(spark):
    plain, odd = forecasts()
    run = lambda x: x[x.index("<time ") if "<time " in x else 0:x.rindex("</time>") + 7 if "</time>" in x else 0]
    texts = [run(x.replace("<!-- <time -->", "").replace("<![CDATA[a<time b]]>", "")) for x in plain]
    left = spark.createDataFrame([(x,) for x in texts], "x STRING").select(F.regexp_replace("x", docs.STEP, ""))
    assert [r[0] for r in left.collect()] == [""] * len(plain)


def test_a_long_run_of_steps_takes_no_stack(spark):
    step = '<time from="2024-01-01T00:00:00" to="2024-01-01T01:00:00">' + '<symbol a="1"/>' * 50_000 + \
        '<precipitation value="1"/><windSpeed mps="2"/><temperature value="3"/><pressure value="4"/></time>'
    text = f"<weatherdata><location><name>x</name></location><forecast><tabular>{step * 2}</tabular></forecast></weatherdata>"
    got = docs.forecast_texts(spark.createDataFrame([(text,)], "x STRING"), F.col("x"), F.lit("p"))
    assert [tuple(r) for r in got.collect()] == [("p", "x", 1704067200, 1704070800, 1.0, 2.0, 3, 4.0)] * 2


def test_payloads_are_computed_once(spark, rows_of):
    df = spark.range(4).select("id", F.sequence(F.lit(1), F.col("id")).alias("n"))
    data = F.when(F.col("id") == 2, F.lit(None)).when(F.col("id") > 0, F.transform("n", lambda i: F.struct(F.upper(i.cast("string")).alias("a")))) \
        .otherwise(F.array().cast("array<struct<a: string>>"))
    got = with_meta_time(wrap(df, data, F.lit(7.5)))
    assert rows_of(got) == [("1", 7), ("1", 7), ("2", 7), ("3", 7)]
    assert "Filter" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_project_rows_are_stored_once(spark, store, monkeypatch):
    written = []
    monkeypatch.setattr(type(store), "write", lambda self, df, name, *rest: written.append(name) or name)
    monkeypatch.setattr(type(store), "read", lambda self, name: spark.range(0))
    governance.stored_tables(Tables(spark, "/root/testdata/sf0.001"), store)
    assert written.count("ubw_per_project_data") == 1 and len(written) == 18


def test_the_refresh_stores_every_pair_of_a_period(spark, store, rows_of, monkeypatch):
    monkeypatch.setattr(R, "REPEATS", 3, raising=False)
    worked = [("1", 5.0, 100)] * 7 + [("1", 5.0, 200), ("1", None, 100), ("1", None, None), ("1", None, None), ("2", 1.5, 100), ("3", 9.0, 100), (None, 2.0, 100)]
    known = [("g1", "1"), ("g1", "1"), ("g2", "1"), ("g2", "2"), ("g3", "1"), ("g4", "4"), (None, "1"), ("g1", None)]
    store.write(spark.createDataFrame(worked, "reg_period STRING, hours DOUBLE, timestamp INT"), "ubw_per_project_data")
    store.write(spark.createDataFrame([(g, p, "s", "x", f"o{p}", "w") for g, p in known], "guid STRING, reg_period STRING, customer STRING, "
                                      "project_type STRING, work_order STRING, work_order_description STRING"), "ubw_customer_per_resource")
    store.write(spark.createDataFrame([("g1", "e1", "m"), ("g2", "e2", None), ("g2", "e3", "m"), (None, "e4", "m")], "guid STRING, email STRING, manager STRING"),
                "active_directory")
    statement = next(q for n, q, _ in governance.WRITTEN if n == "employeeDataUBW")
    projects, hours, directory = (store.read(t) for t in ("ubw_per_project_data", "ubw_customer_per_resource", "active_directory"))
    pairs = projects.join(hours, "reg_period").join(directory, "guid").select(
        "customer", "email", "manager", "guid", "hours", "timestamp", "reg_period", "project_type", "work_order", "work_order_description")
    store.materialize("employeeDataUBW", stored_sql(store)("employeeDataUBW", statement), 3)
    got = store.cached_report("employeeDataUBW", 3)
    assert got.columns == pairs.columns and got.count() == 2 * 11 + 2 * 11 + 2
    assert rows_of(got) == rows_of(pairs)


def test_a_refresh_keeps_no_shuffle_files_of_its_reports(spark, store):
    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(";").split(";") if "/shuffle_" in f}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was, within = files(), spark.conf.get(setting), []
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_removed(spark):
        store.materialize("r", counts, 3)
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(setting) == was
    assert counts.count() == 7 and store.cached_report("r", 3).count() == 7

    store.write(spark.range(9).select(F.col("id").alias("k")), "t")
    registry = spark.createDataFrame([("r", "SELECT k FROM t", ["t"], 3, "x", None, None)], catalogue.REGISTRY)
    run = lambda name, sql: within.append(spark.conf.get(setting)) or store.read("t")
    refresh(store, registry, spark.createDataFrame([("t",)], "table STRING"), run, "now")
    assert within == ["true"] and spark.conf.get(setting) == was


def test_amounts_shuffle_the_answers_once(spark):
    answers = spark.createDataFrame([("e", "q", 4.0, 5.0)] * 3, "email STRING, questionid STRING, knowledge DOUBLE, motivation DOUBLE")
    questions = spark.createDataFrame([("q", "t", "c", "knowledgeMotivation")], "id STRING, topic STRING, categoryid STRING, type STRING")
    got = R.comp_amount(answers, questions, spark.createDataFrame([("c", "x")], "id STRING, text STRING"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(email" in line for line in plan.splitlines()) == 1
    assert [(r["subCategory"], r["subCompetenceAmount"], r["motivationAmount"]) for r in got.collect()] == [("t", 1, 1)]
