"""The named reports over stored tables of the source jobs' shape."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalogue
from tidemark.plans.catalogue import CATALOGUE, run_report
from tidemark.operators.governance import non_select
from tidemark.plans.registry import delete, export_reports, import_reports, refresh, refresh_one, stored_sql
from tidemark.queries.registry import Tables
from tidemark.queries.roles import Roles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    r = Roles(Tables(spark, FOLDER))
    experience = r.employees.select(
        F.col("navn").alias("name"), F.regexp_replace("email", "^c", "a").alias("alias"), F.lit(3).alias("experience"),
        F.lit("2000").alias("examination_year"), F.lit("g").alias("grade"), F.lit("2001").alias("start_year"))
    events = spark.range(9).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_summary"),
                                   (F.col("id") * 86400 * 2400).alias("timestamp_from"), F.col("id").alias("timestamp_to"))
    found = {
        "ubw_experience": experience, "ubw_fagtimer": spark.createDataFrame([("201817", "3")], "reg_period STRING, used_hrs STRING"),
        "cv_partner_employees": r.employees, "cv_partner_education": r.education, "cv_partner_work_experience": r.jobs,
        "cv_partner_languages": r.languages, "cv_partner_technology_skills": r.skills,
        "cv_partner_project_experience": r.experience_rows, "cv_partner_employee_images": r.employees.select("image_key"),
        "ubw_customer_per_resource": r.hours, "ubw_per_project_data": r.projects, "active_directory": r.directory,
        "customer_mapping": r.mapping, "competence_answers": r.answers, "competence_questions": r.questions,
        "competence_categories": r.categories, "google_calendar_events": events,
        "account_managers": spark.createDataFrame([("k", "m")], "kunde STRING, kundeansvarlig STRING"),
    }
    return lambda name: found[name]


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_report_runs(tables, name):
    df = run_report(name, tables, date(2024, 3, 30), ordered=True)
    assert len(set(df.columns)) == len(df.columns)
    if name == "employeeDataUBW":
        df.schema
    elif name == "jobRotationInformation":
        assert df.isEmpty()
    else:
        assert not df.isEmpty()


def test_order(tables):
    counts = [r["count"] for r in run_report("yearsSinceSchoolDist", tables, date(2024, 1, 1), ordered=True).collect()]
    assert counts == sorted(counts, reverse=True)


def test_refresh_and_delete(spark, store, tables):
    run = lambda name, _: run_report(name, tables, date(2024, 3, 30))
    registry = catalogue.registry(spark, lambda table: 2, "2024-01-01")
    changed = spark.createDataFrame([("cv_partner_education",)], "table STRING")
    updated, names = refresh(store, registry, changed, run, "now")
    assert names == sorted(n for n, r in CATALOGUE.items() if "cv_partner_education" in r.tables)
    assert {r["name"] for r in updated.filter("lastCacheUpdate = 'now'").collect()} == set(names)
    assert store.cached_report("degreeDist", 3).count() == 3
    after = delete(store, refresh_one(store, updated, "countEmployees", run, "later"), "countEmployees")
    assert after.count() == len(CATALOGUE) - 1
    with pytest.raises(KeyError):
        refresh_one(store, after, "countEmployees", run, "later")
    with pytest.raises(KeyError):
        delete(store, after, "nobody")



def test_built_in_reports_run_by_their_sql(spark, store, tables):
    registry = catalogue.registry(spark, lambda table: 2, "2024-01-01")
    assert non_select(registry).isEmpty()
    for table in {t for r in CATALOGUE.values() for t in r.tables}:
        store.write(tables(table), table)
    changed = spark.createDataFrame([(t,) for r in CATALOGUE.values() for t in r.tables], "table STRING")
    _, names = refresh(store, registry.filter("name <> 'employeeDataUBW'"), changed, stored_sql(store, date(2024, 3, 30)), "now")
    assert len(names) == len(CATALOGUE) - 1
    for name in ("degreeDist", "debug-marie", "accountManager"):
        want = run_report(name, tables, date(2024, 3, 30))
        assert store.cached_report(name, 3).exceptAll(want).isEmpty()


def test_export_and_import(spark, folder):
    registry = catalogue.registry(spark, lambda table: 2, "2024-01-01")
    path = folder("reports")
    export_reports(registry, path)
    empty = registry.limit(0)
    assert import_reports(empty, path).exceptAll(registry).isEmpty()
    assert import_reports(registry, path, replace=True).count() == len(CATALOGUE)
    bad = folder("reports")
    export_reports(registry.limit(1).withColumn("queryString", F.lit("DROP TABLE x")), bad)
    with pytest.raises(Exception, match="not a SELECT"):
        import_reports(empty, bad).collect()


def test_lineage_reads_every_clause(spark):
    from tidemark.operators.governance import lineage, protection
    statements = {"comma": "SELECT * FROM a, b", "paren": "SELECT * FROM (a JOIN b ON x)", "quoted": 'SELECT * FROM "a"', "none": "SELECT 1 -- FROM b",
                  "with": "WITH b AS (SELECT * FROM a) SELECT * FROM b", "secret": "SELECT 'b' FROM a JOIN level_4_x.d"}
    registry = spark.createDataFrame([(n, s) for n, s in statements.items()], "name STRING, queryString STRING")
    catalog = spark.createDataFrame([("dev_level_1_database", "a"), ("dev_level_2_database", "b"), ("level_4_x", "d")], "database STRING, table STRING")
    lines = lineage(registry, catalog)
    got = {}
    for r in lines.collect():
        got.setdefault(r["name"], set()).add(r["table"])
    assert got == {"comma": {"a", "b"}, "paren": {"a", "b"}, "quoted": {"a"}, "with": {"a"}, "secret": {"a", "d"}}
    assert {r["name"]: (r["level"], r["allowed"]) for r in protection(registry, lines).collect()} == {
        **{n: (3, True) for n in statements}, "secret": (4, False)}


def reading(spark, rows):
    return spark.createDataFrame([(n, q, tables, level, "2024", None, None) for n, q, tables, level in rows], catalogue.REGISTRY)


def test_reports_that_read_reports(spark, store, monkeypatch):
    from tidemark.plans.registry import Graph, report_tables
    store.write(spark.range(10), "numbers")
    registry = reading(spark, [
        ("d", "SELECT b.n + c.n AS n FROM b CROSS JOIN c", ["b", "c"], 3), ("b", "SELECT n * 2 AS n FROM a", ["a"], 3),
        ("a", "SELECT count(*) AS n FROM numbers", ["numbers"], 2), ("c", "SELECT sum(id) AS n FROM numbers", ["numbers"], 3),
        ("apart", "SELECT 1 AS n", ["other"], 3)])
    changed = spark.createDataFrame([("numbers",)], "table STRING")
    updated, names = refresh(store, registry, changed, None, "now")
    assert names == ["a", "c", "b", "d"] and Graph(store, registry).waves({"a", "c"}) == [["a", "c"], ["b"], ["d"]]
    assert store.cached_report("d", 3).first()["n"] == 65
    assert {r["name"] for r in updated.filter("lastCacheUpdate = 'now'").collect()} == set("abcd")
    store.write(spark.range(3), "numbers")
    refresh(store, registry, changed, None, "later")
    assert store.cached_report("d", 3).first()["n"] == 26 + 48
    # an unstored report is computed for the one that reads it
    store.drop_materialized("a", 2)
    assert refresh(store, registry, spark.createDataFrame([("a",)], "table STRING"), None, "x")[1] == ["a", "b", "d"]
    assert {tuple(r) for r in report_tables(registry).collect()} >= {("reports_level_2", "a"), ("reports_level_3", "b")}


def test_circles_and_higher_levels_are_refused(spark, store):
    store.write(spark.range(10), "numbers")
    changed = spark.createDataFrame([("numbers",)], "table STRING")
    circle = reading(spark, [("a", "SELECT * FROM b", ["b", "numbers"], 3), ("b", "SELECT * FROM a", ["a"], 3)])
    with pytest.raises(ValueError, match="read each other"):
        refresh(store, circle, changed, None, "now")
    assert not store.has_report("a", 3)
    higher = reading(spark, [("a", "SELECT * FROM numbers", ["numbers"], 3), ("b", "SELECT * FROM a", ["a"], 2)])
    with pytest.raises(PermissionError):
        refresh(store, higher, changed, None, "now")
    assert not store.has_report("b", 2)


@pytest.mark.parametrize("sql, want", [
    ("select customer, count(*) from deployments group by customer", {"deployments"}),
    ("select deployments.x as customer from deployments where y = 'from customer'", {"deployments"}),
    ("select customer.x from deployments customer", {"deployments"}),
    ("with customer as (select 1 as x) select * from customer", set()),
    ("with customer as (select * from customer) select * from customer", {"customer"}),
    ("with a as (with customer as (select 1) select * from customer) select * from a, customer", {"customer"}),
    ("with a as (select * from b), b as (select 1) select * from a, b", {"b"}),
    ("select * from a where exists (select 1 from b where b.x = a.x and b.y in (select y from c))", {"a", "b", "c"}),
    ("select (select max(x) from b) from a union all select 1 from (select * from c) z", {"a", "b", "c"}),
    ("select * from a, lateral (select * from b where b.x = a.x) l", {"a", "b"}),
    ("with recursive r as (select 1 as n union all select n + 1 from r where n < 3) select * from r join a on true", {"a"}),
    ("SELECT * FROM Db.A JOIN `b` ON 1 = 1", {"db.a", "b"}),
    ('SELECT "customer" FROM "Deployments"', {"deployments"}),
    ("select cast(x as varchar) from a join b on 1 = 1", {"cast", "x", "varchar", "a", "join", "b", "on", "select", "from", "as"}),
    ("", set()), ("nonsense (", {"nonsense"}),
])
def test_tables_of_a_statement(spark, sql, want):
    from tidemark.operators.governance import referenced
    registry = spark.createDataFrame([("r", sql), ("r2", sql), ("empty", None)], "name STRING, queryString STRING")
    found = referenced(registry).collect()
    assert {r["ref"] for r in found if r["name"] == "r"} == {r["ref"] for r in found if r["name"] == "r2"} == want
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_a_harmless_report_stays_allowed(spark):
    from tidemark.operators.governance import lineage, protection
    registry = spark.createDataFrame([("r", "select customer, count(*) from deployments group by customer")], "name STRING, queryString STRING")
    catalog = spark.createDataFrame([("dev_level_1_database", "deployments"), ("dev_level_4_database", "customer")], "database STRING, table STRING")
    assert [tuple(r) for r in protection(registry, lineage(registry, catalog)).collect()] == [("r", 3, True)]


def test_upsert_keeps_names_unique(spark):
    from tidemark.operators.governance import upsert
    old = spark.createDataFrame([("x", "select 1", "2024")], "name STRING, queryString STRING, created STRING")
    new = spark.createDataFrame([("y", "select 2", "2024"), ("y", "select 3", "2025"), ("x", "select 4", "2025")], old.schema)
    assert sorted(map(tuple, upsert(old, new).collect())) == [("x", "select 1", "2024"), ("y", "select 3", "2025")]
    assert sorted(map(tuple, upsert(old, new, replace=True).collect())) == [("x", "select 4", "2025"), ("y", "select 3", "2025")]
