"""§ report registry and access rules. Every customer stands for one stored report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import governance as G
from ..plans import catalogue
from ..plans.registry import Graph, delete, export_reports, import_reports, refresh, stored_sql
from ..session import new_folder, shuffles_removed
from ..tables.store import TableStore
from . import reports  # noqa: F401  registers the SQL of the reports
from .registry import ORACLES, query
from .roles import Roles
from .roles import sql as role_sql

def statements(seg, key, other, join):
    """By nation, a statement over the customer's segment `seg` and `nation_<key>`, composed by `join`. Each line below says what it reads."""
    return [
        (0, join("SELECT ", seg, ", count(*) AS nation_", other, " FROM nation_", key, " GROUP BY ", seg)),  # nation
        (1, join("WITH a AS (WITH ", seg, " AS (SELECT 1 AS x) SELECT * FROM ", seg, ") SELECT * FROM a JOIN nation_", key, " ON 1 = 1")),  # nation
        (2, join("WITH ", seg, " AS (SELECT * FROM ", seg, ") SELECT * FROM ", seg, " WHERE x IN (SELECT y FROM nation_", key, ")")),  # both
        (3, join("DELETE FROM ", seg)),  # segment
        (4, join("SELECT * FROM ", seg, ", nation_", key, " n")),  # both
        (5, join("SELECT * FROM (", seg, " JOIN nation_", key, " ON x = y)")),  # both
        (6, join('SELECT "a" FROM "', seg, '" JOIN dev_level_2_database."', seg, '" ON 1 = 1')),  # segment, also of one database
        (7, join("SELECT 'from nation_1' AS its /* nation_2 */ -- nation_8\n", "FROM nation_", key)),  # nation
        (8, join("SELECT ", seg, ".x, (SELECT max(nation_", other, ") FROM nation_", key, ") FROM dev_level_1_database.", seg, " AS ", seg)),  # nation, segment of one database
        (9, join("SELECT a, cast(year_from AS int) FROM ", seg, " JOIN nation_", key, " ON x = y")),  # both
        (19, join("WITH recent AS (SELECT * FROM dev_level_2_database.", seg, ")\n", "SELECT * FROM recent\n", "LEFT JOIN nation_", key, " n ON 1 = 1")),  # segment of one database, nation
        (99, join("select * from unknown_table join (select 1) z on true")),  # neither
    ]


def _sql_text(*parts):
    return " || ".join("'" + p.replace("'", "''") + "'" if p not in (SEG, KEY, OTHER) else p for p in parts)


SEG, KEY, OTHER = "lower(c_mktsegment)", "c_nationkey", "(c_nationkey + 1)"
REGISTRY_SQL = f"""
    registry AS (SELECT c_name AS name, c_nationkey AS kind, lower(c_mktsegment) AS seg, CASE
        {" ".join(f"WHEN c_nationkey <= {k} THEN {sql}" for k, sql in statements(SEG, KEY, OTHER, _sql_text))} END AS "queryString" FROM customer),
    catalog AS (
      SELECT DISTINCT 'dev_level_' || (1 + length(c_mktsegment) % 3) || '_database' AS database, lower(c_mktsegment) AS "table"
      FROM customer
      UNION SELECT 'dev_level_2_database', lower(c_mktsegment) FROM customer
      UNION SELECT 'dev_level_' || (1 + n_regionkey % 4) || '_database', 'nation_' || n_nationkey FROM nation),
    used AS (
      SELECT name, seg AS "table", CASE WHEN kind = 8 THEN 'dev_level_1_database' WHEN kind BETWEEN 10 AND 19 THEN 'dev_level_2_database' END AS given
      FROM registry WHERE kind BETWEEN 2 AND 6 OR kind BETWEEN 8 AND 19
      UNION ALL SELECT name, seg, 'dev_level_2_database' FROM registry WHERE kind = 6
      UNION ALL SELECT name, 'nation_' || kind, NULL FROM registry WHERE kind IN (0, 1, 2, 4, 5, 7, 8, 9) OR kind BETWEEN 10 AND 19),
    lines AS (SELECT DISTINCT name, database, catalog."table" FROM used JOIN catalog ON used."table" = catalog."table"
              WHERE given IS NULL OR given = database)"""


def registry(t):
    seg, key, other = F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"), (F.col("c_nationkey") + 1).cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    sql = None
    for kind, statement in statements(seg, key, other, text):
        here = F.col("c_nationkey") <= kind
        sql = F.when(here, statement) if sql is None else sql.when(here, statement)
    empty = F.lit(None).cast("string")
    return t.customer.select(
        F.col("c_name").alias("name"), sql.alias("queryString"),
        F.array(seg, F.concat(F.lit("nation_"), key)).alias("tables"), F.lit(3).alias("dataProtection"),
        F.lit("2024-01-01").alias("created"), empty.alias("lastUsed"), empty.alias("lastCacheUpdate"))


def catalog(t):
    level = lambda n: F.concat(F.lit("dev_level_"), n.cast("string"), F.lit("_database")).alias("database")
    seg = F.lower("c_mktsegment").alias("table")
    own = t.customer.select(level(1 + F.length("c_mktsegment") % 3), seg)
    copy = t.customer.select(level(F.lit(2)), seg)
    nations = t.nation.select(level(1 + F.col("n_regionkey") % 4),
                              F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("table"))
    return own.union(copy).union(nations).distinct()


@query("report_lineage", f"WITH {REGISTRY_SQL} SELECT * FROM lines")
def report_lineage(t):
    return G.lineage(registry(t), catalog(t))


@query("report_protection", f"""
    WITH {REGISTRY_SQL}, levels AS (SELECT name, CAST(regexp_extract(database, 'level_(\\d)', 1) AS INTEGER) AS l FROM lines)
    SELECT registry.name, greatest(3, coalesce(max(l), 3)) AS level, coalesce(max(l), 3) <= 3 AS allowed
    FROM registry LEFT JOIN levels ON registry.name = levels.name GROUP BY registry.name""")
def report_protection(t):
    return G.protection(registry(t), G.lineage(registry(t), catalog(t)))


@query("report_select_only", f"""
    WITH {REGISTRY_SQL} SELECT name, "queryString" FROM registry
    WHERE NOT regexp_matches(lower("queryString"), '^\\s*(select|with)\\b')""")
def report_select_only(t):
    return G.non_select(registry(t)).select("name", "queryString")


def changed(t):
    """Some tables were updated: those of the nations of one region."""
    return t.nation.filter("n_regionkey = 2").select(
        F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("table"))


@query("report_dependents", """
    SELECT c_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2""")
def report_dependents(t):
    return G.dependents(registry(t), changed(t))


def incoming(t):
    """Reports named after suppliers and the first customers, by another author."""
    names = t.supplier.select(F.regexp_replace("s_name", "Supplier", "Customer").alias("name"))
    empty = F.lit(None).cast("string")
    return names.select("name", F.lit("select 1").alias("queryString"), F.array(F.lit("t")).alias("tables"),
                        F.lit(1).alias("dataProtection"), F.lit("2024-02-02").alias("created"),
                        empty.alias("lastUsed"), empty.alias("lastCacheUpdate"))


@query("report_upsert", """
    WITH old AS (SELECT c_name AS name FROM customer), new AS (SELECT replace(s_name, 'Supplier', 'Customer') AS name FROM supplier)
    SELECT 'create' AS mode, name, '2024-01-01' AS created FROM old
    UNION ALL SELECT 'create', name, '2024-02-02' FROM new WHERE name NOT IN (SELECT name FROM old)
    UNION ALL SELECT 'replace', name, '2024-01-01' FROM old WHERE name NOT IN (SELECT name FROM new)
    UNION ALL SELECT 'replace', name, '2024-02-02' FROM new""")
def report_upsert(t):
    created = G.upsert(registry(t), incoming(t)).select(F.lit("create").alias("mode"), "name", "created")
    replaced = G.upsert(registry(t), incoming(t), replace=True)
    return created.union(replaced.select(F.lit("replace"), "name", "created"))


@query("report_delete", """
    SELECT c_name AS name FROM customer WHERE c_name <> (SELECT min(c_name) FROM customer)""")
def report_delete(t):
    store = TableStore(t.spark, new_folder(t.spark, "reports"))
    first = t.customer.agg(F.min("c_name").alias("n")).head()["n"]
    store.materialize(first, t.customer.select("c_custkey"), 3)
    return delete(store, registry(t), first).select("name")


#: Report names and the queries that say how many rows each has over the tables of `stored_tables`.
SIZES = {
    "ubwExperience": "r_experience", "employeeInformation": "r_employee_information", "ageDistribution": "r_age_distribution",
    "fagActivity": "r_activity", "employeeSkills": "r_employee_skills", "employeeImages": "r_employee_images",
    "ageDistributionGroups": "r_age_groups", "basicEmployeeInformation": "r_basic_employee", "allProjectsOverview": "r_all_projects",
    "newCategories": "r_categories", "projectStatus": "r_project_status", "newCompetenceMotivationAverages": "r_comp_mot_averages",
    "competenceAmountAggregated": "r_comp_amount", "employeesWithPrimaryCustomer": "r_primary_customer",
    "employeeProfileInformation": "r_profile", "countEmployees": "r_count_employees", "fullProfile4": "r_profile_unmatched",
    "employeeCustomers": "r_employee_customers", "workExperienceDistributedInYears": "r_experience_years",
    "workExperience": "r_work_experience", "debug-marie": "r_comp_amount_rated", "fullProfile7": "r_profile",
    "newCompetenceAverage": "r_competence_avg", "averageCompetenceAndMotivation": "r_avg_comp_mot", "filteredCategories": "r_categories",
    "yearsSinceSchoolDist": "r_years_since_school", "degreeDist": "r_degree_distribution", "projectExperience": "r_project_experience",
    "fagEvents": "r_events", "employeeMotivationAndCompetence": "r_employee_mot_comp", "perProject": "r_per_project",
    "newMotivationAverage": "r_motivation_avg", "accountManager": "r_account_manager",
    "employeeMotivationAndCompetence2": "r_employee_mot_comp", "employeeWorkStatus": "r_work_status",
}
DAY = date(2024, 6, 30)


def sizes_sql(names) -> str:
    """The queries of these reports counted, those that hang on the day as of DAY."""
    as_of = lambda sql: sql.replace("2027-01-15", DAY.isoformat()).replace("2003-03-30", DAY.isoformat())
    return " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM ({as_of(ORACLES[SIZES[name]])})" for name in names)


def refresh_sql() -> str:
    return f"""
    WITH sizes AS ({sizes_sql(SIZES)}
      UNION ALL SELECT 'jobRotationInformation', 0
      UNION ALL SELECT 'employeeDataUBW', count(*) FROM (WITH {role_sql("projects", "hours", "directory")}
        SELECT * FROM projects JOIN hours ON projects.reg_period = hours.reg_period JOIN directory ON directory.guid = hours.guid)
    ),
    results AS (SELECT name, n, NULL AS value FROM sizes
      UNION ALL SELECT 'people', 1, (SELECT count(*) FROM customer)
      UNION ALL SELECT 'peoplePerAge', n, (SELECT sum("count") FROM ({ORACLES['r_age_distribution']})) * (SELECT count(*) FROM customer)
        FROM sizes WHERE name = 'ageDistribution')
    SELECT name, n, CAST(value AS BIGINT) AS value, CASE name WHEN 'people' THEN 2 WHEN 'peoplePerAge' THEN 3 ELSE 1 END AS wave,
           '2024-06-30' AS "lastCacheUpdate" FROM results"""


def stored_tables(t, store):
    """The tables that the built-in reports read, stored as their source jobs store them."""
    r = Roles(t)
    people = t.customer.select(
        F.col("c_name").alias("name"), F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("alias"),
        F.col("c_nationkey").alias("experience"), F.lit(None).cast("string").alias("examination_year"),
        F.col("c_mktsegment").alias("grade"), F.lit("2001").alias("start_year"))
    weeks = t.events.groupBy(F.concat(F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"), F.weekofyear("ts").cast("string")).alias("reg_period"))
    day = F.unix_timestamp(F.date_trunc("day", "ts"))
    events = t.events.select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("event_summary"),
                             day.alias("timestamp_from"), (day + 3600).alias("timestamp_to"))
    managers = t.supplier.select(F.col("s_name").alias("kunde"), F.concat(F.lit("k"), F.col("s_nationkey").cast("string")).alias("kundeansvarlig"))
    tables = {
        "ubw_experience": people, "ubw_fagtimer": weeks.agg(F.count(F.lit(1)).alias("used_hrs")), "cv_partner_employees": r.employees,
        "cv_partner_education": r.education, "cv_partner_work_experience": r.jobs, "cv_partner_languages": r.languages,
        "cv_partner_technology_skills": r.skills, "cv_partner_project_experience": r.experience_rows,
        "cv_partner_employee_images": t.pages.select(F.col("page_id").alias("user_id"), F.col("url").alias("image")),
        "ubw_customer_per_resource": r.hours, "ubw_per_project_data": r.project_rows, "active_directory": r.directory,
        "customer_mapping": r.mapping, "competence_answers": r.answers, "competence_questions": r.questions,
        "competence_categories": r.categories, "google_calendar_events": events, "account_managers": managers}
    with shuffles_removed(t.spark):
        return store.write_all(tables)


#: Reports over reports, and a built-in one that is imported once more and so replaced.
WRITTEN = [
    ("people", "SELECT sum(antallAnsatte) AS value FROM countEmployees", ["countEmployees"]),
    ("peoplePerAge", "SELECT age, a.count * p.value AS value FROM ageDistribution a CROSS JOIN people p", ["ageDistribution", "people"]),
    ("employeeDataUBW", "SELECT * FROM `employeeDataUBW`", list(catalogue.CATALOGUE["employeeDataUBW"].tables)),
]


@query("report_refresh", refresh_sql())
def report_refresh(t):
    """All reports of the catalogue, exported and imported, over their stored tables; some read others."""
    store, files_of = TableStore(t.spark, new_folder(t.spark, "reports")), new_folder(t.spark, "exported")
    names = stored_tables(t, store)
    built_in = catalogue.registry(t.spark, lambda table: 2, "2024-01-01")
    export_reports(built_in, files_of)
    imported = import_reports(built_in.limit(0), files_of)
    own, more = new_folder(t.spark, "exported"), [(n, q, tables, 3, "2024-02-01", None, None) for n, q, tables in WRITTEN]
    export_reports(t.spark.createDataFrame(more, catalogue.REGISTRY), own)
    registry = import_reports(imported, own, replace=True)
    changed = t.spark.createDataFrame([(n,) for n in names], "table STRING")
    updated, refreshed = refresh(store, registry, changed, stored_sql(store, DAY), "2024-06-30")
    graph = Graph(store, registry)
    waves = {name: n for n, wave in enumerate(graph.waves(set(refreshed)), 1) for name in wave}
    out = None
    for name in refreshed:
        stored = store.cached_report(name, 3)
        value = F.sum("value").cast("bigint") if name in ("people", "peoplePerAge") else F.lit(None).cast("bigint")
        one = stored.agg(F.count(F.lit(1)).alias("n"), value.alias("value")).select(F.lit(name).alias("name"), "n", "value", F.lit(waves[name]).alias("wave"))
        out = one if out is None else out.unionByName(one)
    return out.join(updated.select("name", "lastCacheUpdate"), "name")
