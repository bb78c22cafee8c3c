"""§ report catalogue on the roles of roles.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports as R
from .registry import cents, query
from .roles import Roles, sql

LAST_DEGREE = """degrees AS (SELECT user_id, degree FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY year_to DESC, degree DESC) AS n FROM education) WHERE n = 1)"""
SHEET = """sheet AS (SELECT DISTINCT "dagens ubw prosjekt" AS old, arbeids_ordre AS old_order, kunde, prosjekt FROM mapping)"""
TOPICS = """topics AS (SELECT q.id AS questionid, topic, c.text AS category, type FROM questions q
      JOIN categories c ON q.categoryid = c.id WHERE c.text <> 'Jobbrotasjon'),
    rated AS (SELECT a.*, topic, category, type FROM answers a JOIN topics ON a.questionid = topics.questionid)"""
COMPETENCE = sql("answers", "questions", "categories") + ",\n    " + TOPICS


@query("r_experience", f"""
    WITH {sql("hours", "directory")}, people AS (
      SELECT c_name AS name, 'a' || c_custkey AS alias, c_nationkey AS experience, c_mktsegment AS grade FROM customer)
    SELECT DISTINCT p.name, d.email, p.alias, p.experience, CAST(NULL AS VARCHAR) AS examination_year, p.grade, '2001' AS start_year,
           d.guid FROM people p JOIN (SELECT DISTINCT upper(alias) AS alias, guid FROM hours) h ON upper(p.alias) = h.alias
    JOIN directory d ON d.guid = h.guid""")
def r_experience(t):
    r = Roles(t)
    people = t.customer.select(
        F.col("c_name").alias("name"), F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("alias"),
        F.col("c_nationkey").alias("experience"), F.lit(None).cast("string").alias("examination_year"),
        F.col("c_mktsegment").alias("grade"), F.lit("2001").alias("start_year"))
    return R.experience(people, r.hours, r.directory)


@query("r_employee_information", f"""
    WITH {sql("employees", "education", "hours", "mapping", "directory")}, {LAST_DEGREE}, {SHEET},
    cost AS (SELECT guid, CASE WHEN old IS NULL THEN customer ELSE kunde END AS customer, weigth AS weight,
             CASE WHEN old IS NULL THEN work_order_description ELSE prosjekt END AS work_order_description
             FROM hours LEFT JOIN sheet ON old = customer AND old_order = work_order_description)
    SELECT e.user_id, e.guid, navn, manager, title, link, degree, e.email, image_key, customer, weight, work_order_description
    FROM employees e LEFT JOIN degrees USING (user_id) LEFT JOIN cost ON cost.guid = e.guid
    LEFT JOIN directory d ON d.guid = e.guid""")
def r_employee_information(t):
    r = Roles(t)
    return R.employee_information(r.employees, r.education, r.hours, r.mapping, r.directory)


@query("r_age_distribution", f"""
    WITH {sql("employees")} SELECT 2024 - born_year AS age, count(*) AS "count" FROM employees
    WHERE born_year > 0 AND 2024 - born_year > 10 GROUP BY 1""")
def r_age_distribution(t):
    return R.age_distribution(Roles(t).employees, 2024)


@query("r_employee_hours", f"""
    WITH {sql("hours", "directory")},
    company AS (SELECT strftime(o_orderdate, '%Y%m') AS reg_period, sum(o_totalprice) * 0 + count(*) AS hours, 7 AS timestamp
                FROM orders GROUP BY 1)
    SELECT h.customer, d.email, d.manager, h.guid, c.hours, c.timestamp, c.reg_period, project_type, work_order,
           work_order_description FROM company c JOIN hours h ON c.reg_period = h.reg_period JOIN directory d ON d.guid = h.guid""")
def r_employee_hours(t):
    """Bound to company-wide projects, one row per period, so the period join stays one to many."""
    r = Roles(t)
    company = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("reg_period")).agg(
        F.count(F.lit(1)).cast("double").alias("hours"), F.lit(7).alias("timestamp"))
    return R.employee_hours(company, r.hours, r.directory)


@query("r_activity", """
    SELECT CAST(isoyear(ts) AS VARCHAR) AS year, CAST(week(ts) AS VARCHAR) AS week, count(*) AS used_hrs FROM events GROUP BY ALL""")
def r_activity(t):
    weeks = t.events.groupBy(F.concat(F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"),
                                      F.weekofyear("ts").cast("string")).alias("reg_period"))
    return R.activity(weeks.agg(F.count(F.lit(1)).alias("used_hrs")))


@query("r_employee_skills", f"""
    WITH {sql("employees", "languages", "skills", "experience_rows")},
    l AS (SELECT user_id, string_agg(DISTINCT name, ';' ORDER BY name) AS language FROM languages GROUP BY 1),
    s AS (SELECT user_id, string_agg(DISTINCT category, ';' ORDER BY category) AS skill FROM skills
          WHERE category <> '' AND technology_skills <> '' GROUP BY 1),
    r AS (SELECT user_id, string_agg(DISTINCT roles, ';' ORDER BY roles) AS role FROM experience_rows WHERE roles <> '' GROUP BY 1)
    SELECT user_id, email, language, skill, role FROM employees JOIN l USING (user_id) JOIN s USING (user_id)
    JOIN r USING (user_id)""")
def r_employee_skills(t):
    r = Roles(t)
    return R.employee_skills(r.employees, r.languages, r.skills, r.experience_rows)


@query("r_employee_images", "SELECT page_id AS user_id, url AS image FROM pages")
def r_employee_images(t):
    return R.passthrough(t.pages.select(F.col("page_id").alias("user_id"), F.col("url").alias("image")))


@query("r_age_groups", f"""
    WITH {sql("employees")} SELECT CASE WHEN age <= 30 THEN 'under 30' WHEN age <= 40 THEN 'under 40' WHEN age <= 50 THEN 'under 50'
      ELSE 'over 50' END AS age_group, count(*) AS "count" FROM (SELECT 2024 - born_year AS age FROM employees WHERE born_year > 0)
    WHERE age > 10 GROUP BY 1""")
def r_age_groups(t):
    return R.age_groups(Roles(t).employees, 2024)


PRIMARY = """
    newest AS (SELECT *, rank() OVER (PARTITION BY guid ORDER BY time DESC) AS r FROM hours),
    prim AS (SELECT guid, CASE WHEN old IS NULL THEN customer ELSE kunde END AS customer,
             CASE WHEN old IS NULL THEN work_order_description ELSE prosjekt END AS wo
             FROM newest LEFT JOIN sheet ON old = customer AND old_order = work_order_description WHERE r = 1 AND weigth = 1)"""


@query("r_basic_employee", f"""
    WITH {sql("employees", "hours", "mapping")}, {SHEET}, {PRIMARY}
    SELECT user_id, e.guid, email, navn AS name, title, link, image_key, customer AS primary_customer,
           wo AS primary_work_order_description FROM employees e LEFT JOIN prim ON prim.guid = e.guid""")
def r_basic_employee(t):
    r = Roles(t)
    return R.basic_employee(r.employees, r.hours, r.mapping)


@query("r_primary_customer", f"""
    WITH {sql("employees", "hours", "mapping")}, {SHEET}, {PRIMARY}
    SELECT user_id, e.guid, email, navn, title, link, image_key, customer AS customer_name, wo AS work_order_description
    FROM employees e JOIN prim ON prim.guid = e.guid""")
def r_primary_customer(t):
    r = Roles(t)
    return R.primary_customer(r.employees, r.hours, r.mapping)


@query("r_all_projects", f"""
    WITH {sql("projects", "mapping")},
    total AS (SELECT customer, work_order, sum(hours) AS billed FROM (
        SELECT *, rank() OVER (PARTITION BY customer, reg_period ORDER BY timestamp DESC) AS r FROM projects) WHERE r = 1
      GROUP BY customer, employees, work_order),
    last AS (SELECT DISTINCT customer, work_order, hours FROM (
        SELECT *, rank() OVER (PARTITION BY customer, work_order ORDER BY reg_period DESC) AS r FROM projects) WHERE r = 1),
    snap AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY customer, reg_period, work_order ORDER BY timestamp DESC) AS r
             FROM projects) WHERE r = 1),
    crew AS (SELECT customer, work_order, max(employees) AS n FROM (
        SELECT *, rank() OVER (PARTITION BY customer ORDER BY reg_period DESC) AS place FROM snap) WHERE place <= 5
      GROUP BY customer, work_order)
    SELECT CASE WHEN m.kunde IS NULL THEN total.customer ELSE m.kunde END AS customer, sum(billed) AS "billedTotal",
           sum(last.hours) AS "billedLastPeriod", CAST(sum(crew.n) AS BIGINT) AS consultants
    FROM total JOIN last ON total.customer = last.customer AND total.work_order = last.work_order
    JOIN crew ON total.customer = crew.customer AND total.work_order = crew.work_order
    LEFT JOIN mapping m ON m."dagens ubw prosjekt" = total.customer AND m.arbeids_ordre = total.work_order GROUP BY 1""")
def r_all_projects(t):
    r = Roles(t)
    return R.all_projects(r.projects, r.mapping)


@query("r_categories", f"""
    WITH {sql("questions", "categories")} SELECT c.text AS category, CAST(to_json(list_sort(list(DISTINCT topic))) AS VARCHAR)
      AS "subCategories" FROM questions q JOIN categories c ON q.categoryid = c.id
    WHERE c.text <> 'Jobbrotasjon' AND type = 'knowledgeMotivation' GROUP BY c.text""")
def r_categories(t):
    r = Roles(t)
    return R.categories(r.questions, r.categories)


@query("r_project_status", f"WITH {sql('employees')} SELECT user_id, navn, title, email FROM employees")
def r_project_status(t):
    return R.project_status(Roles(t).employees)


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, cents(F.col(c), 8))
    return df


@query("r_comp_mot_averages", f"""
    WITH {COMPETENCE} SELECT round(avg(knowledge), 8) AS competence, round(avg(motivation), 8) AS motivation,
      topic AS "subCategory", category FROM rated GROUP BY topic, category""")
def r_comp_mot_averages(t):
    r = Roles(t)
    return rounded(R.comp_mot_averages(r.answers, r.questions, r.categories), "competence", "motivation")


AMOUNT_SQL = """
    WITH {competence},
    person AS (SELECT email, category, avg(motivation) AS m, avg(knowledge) AS k FROM rated {where} GROUP BY email, category),
    base AS (SELECT DISTINCT email, motivation, knowledge, topic, category, m, k FROM rated JOIN person USING (email, category)),
    topic_counts AS (SELECT topic, category, count(*) FILTER (motivation > 3) AS sm, count(*) FILTER (knowledge > 3) AS sk
                     FROM base GROUP BY topic, category),
    category_counts AS (SELECT category, count(*) FILTER (m > 3) AS cm, count(*) FILTER (k > 3) AS ck, count(DISTINCT email) AS n
                        FROM base GROUP BY category)
    SELECT topic AS "subCategory", sm AS "subMotivationAmount", round(100.0::DOUBLE * sm / n, 8) AS "subMotivationPropotion",
      sk AS "subCompetenceAmount", round(100.0::DOUBLE * sk / n, 8) AS "subCompetencePropotion", category,
      cm AS "motivationAmount", round(cm::DOUBLE / n, 8) AS "motivationPropotion", ck AS "competenceAmount",
      round(ck::DOUBLE / n, 8) AS "competencePropotion" FROM topic_counts JOIN category_counts USING (category)"""
SHARES = ("subMotivationPropotion", "subCompetencePropotion", "motivationPropotion", "competencePropotion")


@query("r_comp_amount", AMOUNT_SQL.format(competence=COMPETENCE, where=""))
def r_comp_amount(t):
    r = Roles(t)
    return rounded(R.comp_amount(r.answers, r.questions, r.categories), *SHARES)


@query("r_comp_amount_rated", AMOUNT_SQL.format(competence=COMPETENCE, where="WHERE type = 'knowledgeMotivation'"))
def r_comp_amount_rated(t):
    r = Roles(t)
    return rounded(R.comp_amount(r.answers, r.questions, r.categories, rated_only=True), *SHARES)


@query("r_profile", f"""
    WITH {sql("employees", "education", "directory")}, {LAST_DEGREE}
    SELECT e.user_id, e.guid, e.email, navn AS name, telefon AS phone, title, degree, ad.manager, boss.email AS manager_email, image_key,
      link FROM employees e LEFT JOIN degrees USING (user_id) LEFT JOIN directory ad ON ad.guid = e.guid
    LEFT JOIN directory boss ON boss.displayname IS NOT DISTINCT FROM ad.manager
    WHERE ad.guid IS NOT NULL OR boss.displayname IS NOT NULL""")
def r_profile(t):
    r = Roles(t)
    return R.profile(r.employees, r.education, r.directory)


@query("r_count_employees", """SELECT count(*) AS "antallAnsatte" FROM customer""")
def r_count_employees(t):
    return R.count_employees(Roles(t).employees)


@query("r_profile_unmatched", f"""
    WITH {sql("employees", "education", "directory")}, {LAST_DEGREE},
    person AS (SELECT e.*, degree, manager FROM employees e LEFT JOIN degrees USING (user_id) LEFT JOIN directory d ON d.guid = e.guid)
    SELECT user_id, p.guid, p.email, navn AS name, telefon AS phone, title, degree, p.manager, coalesce(boss.email, 'undefined')
      AS manager_email, image_key, link
    FROM person p FULL JOIN directory boss ON boss.displayname = p.manager WHERE boss.displayname IS NULL OR boss.displayname = ''""")
def r_profile_unmatched(t):
    r = Roles(t)
    return R.profile_unmatched(r.employees, r.education, r.directory)


@query("r_employee_customers", f"""
    WITH {sql("employees", "hours", "mapping")}, {SHEET},
    named AS (SELECT DISTINCT guid, reg_period, CASE WHEN old IS NULL THEN customer ELSE kunde END AS customer,
              CASE WHEN old IS NULL THEN work_order_description ELSE prosjekt END AS wo
              FROM hours LEFT JOIN sheet ON old = customer AND old_order = work_order_description)
    SELECT user_id, email, customer, wo AS work_order_description, string_agg(reg_period, ';' ORDER BY reg_period) AS reg_periods
    FROM employees JOIN named USING (guid) GROUP BY ALL""")
def r_employee_customers(t):
    r = Roles(t)
    return R.employee_customers(r.employees, r.hours, r.mapping)


@query("r_experience_years", f"""
    WITH {sql("employees", "jobs")},
    spans AS (SELECT e.user_id, date_sub('month', TRY_CAST(year_from || '-' || month_from || '-01' AS DATE),
        CASE WHEN month_to = 0 OR year_to = 0 THEN DATE '2003-03-30'
             ELSE TRY_CAST(year_to || '-' || month_to || '-30' AS DATE) END) AS m
      FROM employees e LEFT JOIN jobs USING (user_id))
    SELECT years_working, count(*) AS "count" FROM (
      SELECT user_id, CAST(sum(coalesce(m, 0)) AS BIGINT) // 12 AS years_working FROM spans GROUP BY user_id) GROUP BY 1""")
def r_experience_years(t):
    r = Roles(t)
    return R.experience_years(r.employees, r.jobs, "2003-03-30")


@query("r_work_experience", f"""
    WITH {sql("employees", "jobs")} SELECT j.user_id, email, employer, month_from, year_from, month_to, year_to
    FROM jobs j LEFT JOIN employees e ON e.user_id = j.user_id""")
def r_work_experience(t):
    r = Roles(t)
    return R.work_experience(r.jobs, r.employees)


def average_sql(measure: str) -> str:
    return f"""
    WITH {COMPETENCE} SELECT round(avg({measure}), 8) AS value, topic AS "subCategory", category FROM rated GROUP BY topic, category"""


@query("r_competence_avg", average_sql("knowledge"))
def r_competence_avg(t):
    r = Roles(t)
    return rounded(R.topic_average(r.answers, r.questions, r.categories, "knowledge"), "value")


@query("r_motivation_avg", average_sql("motivation"))
def r_motivation_avg(t):
    r = Roles(t)
    return rounded(R.topic_average(r.answers, r.questions, r.categories, "motivation"), "value")


@query("r_avg_comp_mot", f"""
    WITH {COMPETENCE}, c AS (SELECT topic, category, avg(knowledge) AS k FROM rated GROUP BY ALL),
    m AS (SELECT topic, category, avg(motivation) AS m FROM rated WHERE type = 'knowledgeMotivation' GROUP BY ALL)
    SELECT round(k, 8) AS competence, round(m, 8) AS motivation, topic AS "subCategory", category FROM c JOIN m USING (topic, category)""")
def r_avg_comp_mot(t):
    r = Roles(t)
    return rounded(R.avg_comp_mot(r.answers, r.questions, r.categories), "competence", "motivation")


@query("r_years_since_school", f"""
    WITH {sql("employees", "education")} SELECT 2024 - y AS years, count(*) AS "count" FROM (
      SELECT user_id, max(year_to) AS y FROM employees JOIN education USING (user_id) GROUP BY user_id) GROUP BY y""")
def r_years_since_school(t):
    r = Roles(t)
    return R.years_since_school(r.employees, r.education, 2024)


DEGREES_SQL = f"""
    WITH {sql("employees", "education")}, best AS (
      SELECT user_id, max(CASE WHEN degree LIKE 'PhD%' THEN 3 WHEN degree LIKE 'Master%' THEN 2
        WHEN degree LIKE '% Bachelor' OR degree = 'Ingeniør' THEN 1 ELSE 0 END) AS c FROM employees JOIN education USING (user_id)
      GROUP BY user_id)
    SELECT CASE c WHEN 1 THEN 'bachelor' WHEN 2 THEN 'master' WHEN 3 THEN 'phd' ELSE 'none' END AS degree, count(*) AS "count" FROM best"""


@query("r_degree_distribution", DEGREES_SQL + " WHERE c > 0 GROUP BY c")
def r_degree_distribution(t):
    r = Roles(t)
    return R.degree_distribution(r.employees, r.education)


@query("r_degree_distribution_all", DEGREES_SQL + " GROUP BY c")
def r_degree_distribution_all(t):
    r = Roles(t)
    return R.degree_distribution(r.employees, r.education, with_none=True)


@query("r_project_experience", f"""
    WITH {sql("employees", "experience_rows")} SELECT user_id, email, navn, customer, description, year_from, year_to, month_from,
      month_to FROM experience_rows JOIN employees USING (user_id)""")
def r_project_experience(t):
    r = Roles(t)
    return R.project_experience(r.experience_rows, r.employees)


@query("r_events", """
    SELECT DISTINCT 's' || user_id AS event_summary, date_trunc('day', ts) AS time_from, date_trunc('day', ts) + INTERVAL 1 HOUR
      AS time_to FROM events WHERE date_trunc('day', ts) > DATE '2027-01-15' - INTERVAL 3 YEAR""")
def r_events(t):
    day = F.unix_timestamp(F.date_trunc("day", "ts"))
    rows = t.events.select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("event_summary"),
                           day.alias("timestamp_from"), (day + 3600).alias("timestamp_to"))
    return R.events(rows, "2027-01-15")


@query("r_employee_mot_comp", f"""
    WITH {COMPETENCE}, person AS (SELECT email, category, avg(motivation) AS m, avg(knowledge) AS k FROM rated
      WHERE type = 'knowledgeMotivation' GROUP BY email, category)
    SELECT email, motivation, knowledge AS competence, topic AS "subCategory", category, round(m, 8) AS "categoryMotivationAvg",
      round(k, 8) AS "categoryCompetenceAvg" FROM rated JOIN person USING (email, category)""")
def r_employee_mot_comp(t):
    r = Roles(t)
    return rounded(R.employee_mot_comp(r.answers, r.questions, r.categories), "categoryMotivationAvg", "categoryCompetenceAvg")


@query("r_job_rotation", f"""
    WITH {sql("answers", "questions")} SELECT username, email, questionid, customscalevalue, guid, "index", text, categoryid
    FROM answers JOIN questions ON questionid = id WHERE categoryid = 'c7'""")
def r_job_rotation(t):
    r = Roles(t)
    return R.job_rotation(r.answers, r.questions, "c7")


@query("r_per_project", f"""
    WITH {sql("projects", "mapping")}, newest AS (
      SELECT *, rank() OVER (PARTITION BY customer, reg_period ORDER BY timestamp DESC) AS r FROM projects)
    SELECT employees, hours, reg_period, timestamp, coalesce(m.prosjekt, work_order) AS work_order, coalesce(m.kunde, customer)
      AS customer FROM newest LEFT JOIN mapping m ON m."dagens ubw prosjekt" = customer AND m.arbeids_ordre = work_order WHERE r = 1""")
def r_per_project(t):
    r = Roles(t)
    return R.per_project(r.projects, r.mapping)


@query("r_account_manager", """
    SELECT s_name AS customer, 'k' || s_nationkey AS account_manager FROM supplier""")
def r_account_manager(t):
    return R.account_manager(t.supplier.select(F.col("s_name").alias("kunde"), F.concat(
        F.lit("k"), F.col("s_nationkey").cast("string")).alias("kundeansvarlig")))


@query("r_work_status", f"""
    WITH {sql("hours")} SELECT alias, guid, customer, project_type, max(reg_period) AS last_reg_period,
      CAST(sum(weigth - 1) AS BIGINT) AS weight_sum FROM hours GROUP BY alias, guid, customer, project_type""")
def r_work_status(t):
    return R.work_status(Roles(t).hours)


@query("r_dev_passthrough", "SELECT * FROM supplier")
def r_dev_passthrough(t):
    return R.passthrough(t.supplier)
