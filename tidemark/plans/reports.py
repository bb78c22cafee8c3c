"""The report catalogue: one function per report, tables in, result out.

Each function takes DataFrames with the columns of the source jobs' tables. `mapping` is the
customer mapping sheet (columns `dagens ubw prosjekt`, arbeids_ordre, kunde, prosjekt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.presto import complete_months, date_of
from ..operators.aggregates import degree_class, joined_list, joined_set, json_set, latest_value
from ..operators.joins import left_join, lookup_join, map_dimension, unmatched_full
from ..operators.windows import latest, newest_periods, top_periods
from ..tables.views import View

# Fixed values of the reports.
EXCLUDED_CATEGORY = "Jobbrotasjon"
RATED_TYPE = "knowledgeMotivation"


def _mapped(df: DataFrame, mapping: DataFrame, order: str, replace_order: bool = True) -> DataFrame:
    """Customer (and work order) as the mapping sheet renames them."""
    replace = {"customer": "kunde", **({order: "prosjekt"} if replace_order else {})}
    return map_dimension(df, mapping, {"customer": "dagens ubw prosjekt", order: "arbeids_ordre"}, replace)


def _last_degree(education: DataFrame) -> DataFrame:
    return latest_value(education, ["user_id"], "year_to", "degree").select("user_id", "degree")


# -- people ------------------------------------------------------------------------------


def experience(experience: DataFrame, hours: DataFrame, directory: DataFrame) -> DataFrame:
    """Experience per person with email and guid; aliases compare without case."""
    # The result is grouped by all columns, so the hours shrink to distinct people first.
    people = hours.select(F.upper("alias").alias("_alias"), "guid").distinct() \
        .join(directory.select("guid", "email"), "guid")
    rows = experience.join(people, F.upper(experience["alias"]) == people["_alias"])
    return rows.select("name", "email", "alias", "experience", "examination_year", "grade", "start_year",
                       "guid").distinct()


def employee_information(employees, education, hours, mapping, directory) -> DataFrame:
    person = (employees.select("user_id", "guid", "navn", "title", "link", "email", "image_key")
              .join(_last_degree(education), "user_id", "left")
              .join(directory.select("guid", "manager"), "guid", "left"))
    cost = _mapped(hours.select("guid", "customer", "work_order_description", F.col("weigth").alias("weight")),
                   mapping, "work_order_description")
    return left_join(person, cost, ["guid"]).select(
        "user_id", "guid", "navn", "manager", "title", "link", "degree", "email", "image_key", "customer", "weight",
        "work_order_description")


def _ages(employees: DataFrame, year: int) -> DataFrame:
    return employees.filter("born_year > 0").select((F.lit(year) - F.col("born_year")).alias("age")).filter("age > 10")


def age_distribution(employees, year: int) -> DataFrame:
    return _ages(employees, year).groupBy("age").agg(F.count("age").alias("count"))


def age_groups(employees, year: int) -> DataFrame:
    age = F.col("age")
    group = F.when(age <= 30, "under 30").when(age <= 40, "under 40").when(age <= 50, "under 50").otherwise("over 50")
    return _ages(employees, year).groupBy(group.alias("age_group")).agg(F.count("age").alias("count"))


#: Most equal project rows that one row stands for while pairs are built.
REPEATS = 1024


def employee_hours(projects, hours, directory) -> DataFrame:
    """Project rows beside the people of the same period. As defined, each pair is a row.

    The pairs are the work, so the people of a period are dealt to tasks by their rows' hash, whatever the size of the inputs, and
    the period's project rows go to each of these tasks: equal ones as one row, repeated beside every person.
    """
    tasks = 4 * hours.sparkSession.sparkContext.defaultParallelism
    people = hours.join(directory.select("guid", "email", "manager"), "guid").filter("reg_period IS NOT NULL").select(
        "customer", "email", "manager", "guid", "reg_period", "project_type", "work_order", "work_order_description")
    dealt = people.withColumn("_task", F.pmod(F.xxhash64(*people.columns), F.lit(tasks)).cast("int"))
    equal = (projects.filter("reg_period IS NOT NULL").groupBy("reg_period", "timestamp", "hours").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {REPEATS}"))))
             .withColumn("_n", F.least(F.lit(REPEATS), F.col("_n") - REPEATS * F.col("_part"))).drop("_part"))
    copies = equal.withColumn("_task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    # Merged, the pairs of a period lie together and in one order beside each person, so they are stored as runs.
    place = ["reg_period", "_task"]
    pairs = dealt.repartition(tasks, *place).join(copies.repartition(tasks, *place).hint("merge"), place)
    return pairs.select("*", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(
        "customer", "email", "manager", "guid", "hours", "timestamp", "reg_period", "project_type", "work_order",
        "work_order_description")


def activity(activity_hours) -> DataFrame:
    return activity_hours.select(F.substring("reg_period", 1, 4).alias("year"),
                                 F.substring("reg_period", 5, 6).alias("week"), "used_hrs")


def employee_skills(employees, languages, skills, projects) -> DataFrame:
    spoken = joined_set(languages, ["user_id"], "name", "language")
    known = joined_set(skills.filter("technology_skills != '' AND category != ''"), ["user_id"], "category", "skill")
    played = joined_set(projects.filter("roles != ''"), ["user_id"], "roles", "role")
    return (employees.select("user_id", "email").join(spoken, "user_id").join(known, "user_id")
            .join(played, "user_id").select("user_id", "email", "language", "skill", "role"))


def passthrough(table: DataFrame) -> DataFrame:
    return table.select("*")


def _primary(hours, mapping) -> DataFrame:
    rows = latest(hours.select("guid", "customer", "work_order_description", "weigth", "time"), ["guid"], "time")
    first = rows.filter("weigth = 1").select("guid", "customer", "work_order_description")
    return _mapped(first, mapping, "work_order_description")


def basic_employee(employees, hours, mapping) -> DataFrame:
    return employees.join(_primary(hours, mapping), "guid", "left").select(
        "user_id", "guid", "email", F.col("navn").alias("name"), "title", "link", "image_key",
        F.col("customer").alias("primary_customer"),
        F.col("work_order_description").alias("primary_work_order_description"))


def primary_customer(employees, hours, mapping) -> DataFrame:
    return employees.join(_primary(hours, mapping), "guid").select(
        "user_id", "guid", "email", "navn", "title", "link", "image_key",
        F.col("customer").alias("customer_name"), "work_order_description")


def project_status(employees) -> DataFrame:
    return employees.select("user_id", "navn", "title", "email")


def count_employees(employees) -> DataFrame:
    return employees.agg(F.count(F.lit(1)).alias("antallAnsatte"))


def _profile(employees, education, directory) -> DataFrame:
    person = employees.select("user_id", "guid", "email", F.col("navn").alias("name"), F.col("telefon").alias("phone"),
                              "title", "image_key", "link").join(_last_degree(education), "user_id", "left")
    known = directory.select("guid", "manager", F.lit(True).alias("_known"))
    return person.join(known, "guid", "left")


def profile(employees, education, directory) -> DataFrame:
    """Profile with the manager's email; a missing manager pairs with directory rows without a name."""
    boss = directory.select(F.col("displayName").alias("_boss"), F.col("email").alias("manager_email"))
    rows = _profile(employees, education, directory)
    joined = rows.join(boss, rows["manager"].eqNullSafe(boss["_boss"]), "left")
    return joined.filter(F.col("_known") | F.col("_boss").isNotNull()).select(
        "user_id", "guid", "email", "name", "phone", "title", "degree", "manager", "manager_email", "image_key", "link")


def profile_unmatched(employees, education, directory) -> DataFrame:
    """People whose manager is unknown, and directory rows without a name that manage nobody."""
    boss = directory.select(F.col("displayName").alias("_boss"), F.col("email").alias("_email"))
    rows = unmatched_full(_profile(employees, education, directory).drop("_known"), boss, "manager", "_boss")
    return rows.select("user_id", "guid", "email", "name", "phone", "title", "degree", "manager",
                       F.coalesce("_email", F.lit("undefined")).alias("manager_email"), "image_key", "link")


def employee_customers(employees, hours, mapping) -> DataFrame:
    rows = _mapped(hours.select("guid", "reg_period", "customer", "work_order_description").distinct(),
                   mapping, "work_order_description").distinct()
    people = employees.select("guid", "user_id", "email")
    joined = people.join(rows, "guid").select("user_id", "email", "customer", "work_order_description", "reg_period")
    return joined_list(joined, ["user_id", "email", "customer", "work_order_description"], "reg_period", "reg_periods")


def experience_years(employees, jobs, today: str) -> DataFrame:
    """How many people have worked how many years. Unreadable spans count as nothing."""
    now = F.to_date(F.lit(today))
    start = date_of("year_from", "month_from", F.lit(1))
    end = F.when((F.col("month_to") == 0) | (F.col("year_to") == 0), now) \
        .otherwise(date_of("year_to", "month_to", F.dayofmonth(now)))
    # Summed per person before the join, so a long history is one row when people are matched.
    months = jobs.groupBy("user_id").agg(F.sum(F.coalesce(complete_months(start, end), F.lit(0))).alias("m"))
    copies = employees.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    total = copies.join(months, "user_id", "left").select(
        F.expr("(coalesce(m, 0) * _n) div 12").alias("years_working"))
    return total.groupBy("years_working").agg(F.count("years_working").alias("count"))


def work_experience(jobs, employees) -> DataFrame:
    return jobs.join(employees.select("user_id", "email"), "user_id", "left").select(
        "user_id", "email", "employer", "month_from", "year_from", "month_to", "year_to")


def years_since_school(employees, education, year: int) -> DataFrame:
    last = employees.select("user_id").distinct().join(
        education.groupBy("user_id").agg(F.max("year_to").alias("career_start")), "user_id")
    return (last.groupBy("career_start").agg(F.count("career_start").alias("count"))
            .select((F.lit(year) - F.col("career_start")).alias("years"), "count"))


def degree_distribution(employees, education, with_none: bool = False) -> DataFrame:
    """Highest degree class per person, counted. `with_none` also counts people without a known class."""
    best = education.groupBy("user_id").agg(F.max(degree_class(F.col("degree"))).alias("c"))
    mine = employees.select("user_id").distinct().join(best, "user_id")
    label = F.when(F.col("c") == 1, "bachelor").when(F.col("c") == 2, "master").when(F.col("c") == 3, "phd")
    if with_none:
        label = label.otherwise("none")
    else:
        mine = mine.filter("c > 0")
    return mine.groupBy(label.alias("degree")).agg(F.count("c").alias("count"))


def project_experience(projects, employees) -> DataFrame:
    return projects.join(employees.select("user_id", "navn", "email"), "user_id").select(
        "user_id", "email", "navn", "customer", "description", "year_from", "year_to", "month_from", "month_to")


# -- projects ----------------------------------------------------------------------------


def all_projects(projects, mapping) -> DataFrame:
    """Billed total, last period's hours and consultants per mapped customer."""
    key = ["customer", "work_order"]
    total = (latest(projects, ["customer", "reg_period"], "timestamp")
             .groupBy("customer", "employees", "work_order").agg(F.sum("hours").alias("billedTotal"))
             .select(*key, "billedTotal"))
    last = (latest(projects, key, "reg_period").select(*key, F.col("hours").alias("billedLastPeriod")).distinct())
    # Every period has a row, so rank 5 lies within a customer's five newest periods; only their rows are looked at.
    crews = projects.filter("work_order IS NOT NULL AND timestamp IS NOT NULL").select("customer", "employees", "reg_period", "work_order", "timestamp")
    recent = newest_periods(crews.filter("customer IS NOT NULL AND reg_period IS NOT NULL"), "customer", "reg_period", 5)
    current = latest(lookup_join(crews, recent, ["customer"]).filter("reg_period >= _since").drop("_since"),
                     ["customer", "reg_period", "work_order"], "timestamp")
    consultants = (top_periods(current, ["customer"], "reg_period", 5)
                   .groupBy(*key).agg(F.max("employees").alias("consultants")))
    rows = total.join(last, key).join(consultants, key)
    # The sheet is not deduplicated here: a key mapped twice counts twice, as the report defines it.
    sheet = mapping.select(F.col("`dagens ubw prosjekt`").alias("_c"), F.col("arbeids_ordre").alias("_o"), "kunde")
    named = rows.join(sheet, (F.col("customer") == F.col("_c")) & (F.col("work_order") == F.col("_o")), "left")
    customer = F.when(F.col("_c").isNotNull(), F.col("kunde")).otherwise(F.col("customer"))
    return named.groupBy(customer.alias("customer")).agg(
        F.sum("billedTotal").alias("billedTotal"), F.sum("billedLastPeriod").alias("billedLastPeriod"),
        F.sum("consultants").alias("consultants"))


def per_project(projects, mapping) -> DataFrame:
    """Newest snapshot of each customer and period, with mapped names."""
    rows = latest(projects, ["customer", "reg_period"], "timestamp").select(
        "employees", "hours", "reg_period", "timestamp", "work_order", "customer")
    sheet = mapping.select(F.col("`dagens ubw prosjekt`").alias("_c"), F.col("arbeids_ordre").alias("_o"),
                           "kunde", "prosjekt")
    named = rows.join(sheet, (F.col("customer") == F.col("_c")) & (F.col("work_order") == F.col("_o")), "left")
    hit = F.col("_c").isNotNull()
    return named.select(
        "employees", "hours", "reg_period", "timestamp",
        F.when(hit, F.col("prosjekt")).otherwise(F.col("work_order")).alias("work_order"),
        F.when(hit, F.col("kunde")).otherwise(F.col("customer")).alias("customer"))


def account_manager(sheet) -> DataFrame:
    return sheet.select(F.col("kunde").alias("customer"), F.col("kundeansvarlig").alias("account_manager"))


def work_status(hours) -> DataFrame:
    return hours.groupBy("alias", "guid", "customer", "project_type").agg(
        F.max("reg_period").alias("last_reg_period"), F.sum(F.col("weigth") - 1).alias("weight_sum"))


#: The same, kept up to date from added hours.
WORK_STATUS = View(
    "employeeWorkStatus", "ubw_customer_per_resource", ("alias", "guid", "customer", "project_type"),
    {"last_reg_period": ("max", "reg_period"), "weight_sum": ("sum", "_weight")},
    lambda hours, read: hours.withColumn("_weight", F.col("weigth") - 1))


# -- competence --------------------------------------------------------------------------


def _topics(questions, categories, rated_only: bool, excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    rated = F.coalesce(F.col("type") == RATED_TYPE, F.lit(False))
    asked = questions.filter(rated) if rated_only else questions
    wanted = categories.filter(F.col("text") != excluded).select(F.col("id").alias("categoryid"),
                                                                 F.col("text").alias("category"))
    return asked.select(F.col("id").alias("questionid"), F.col("topic").alias("subCategory"), "categoryid",
                        rated.alias("_rated")).join(wanted, "categoryid").drop("categoryid")


def categories(questions, categories, rated_only: bool = True, excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    topics = _topics(questions, categories, rated_only, excluded)
    return json_set(topics, ["category"], "subCategory", "subCategories")


def topic_average(answers, questions, categories, measure: str, rated_only: bool = False,
                  excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    """Average of `knowledge` or `motivation` per topic and category."""
    rows = answers.join(_topics(questions, categories, rated_only, excluded), "questionid")
    return rows.groupBy("subCategory", "category").agg(F.avg(measure).alias("value")) \
        .select("value", "subCategory", "category")


def comp_mot_averages(answers, questions, categories, excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    """Both averages. Their filters are equal, so one aggregate gives both."""
    rows = answers.join(_topics(questions, categories, False, excluded), "questionid")
    return rows.groupBy("subCategory", "category").agg(
        F.avg("knowledge").alias("competence"), F.avg("motivation").alias("motivation")) \
        .select("competence", "motivation", "subCategory", "category")


#: The same, kept up to date from added answers; changed questions or categories compute it anew.
COMP_MOT_AVERAGES = View(
    "newCompetenceMotivationAverages", "competence_answers", ("subCategory", "category"),
    {"competence": ("average", "knowledge"), "motivation": ("average", "motivation")},
    lambda answers, read: answers.join(_topics(read("competence_questions"), read("competence_categories"), False), "questionid"),
    ("competence_questions", "competence_categories"))


def avg_comp_mot(answers, questions, categories, rated_only: bool = True,
                 excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    """Competence over all questions beside motivation over the rated ones; topics with both."""
    rows = answers.join(_topics(questions, categories, False, excluded), "questionid")
    if not rated_only:
        rows = rows.withColumn("_rated", F.lit(True))
    both = rows.groupBy("subCategory", "category").agg(
        F.avg("knowledge").alias("competence"),
        F.avg(F.when(F.col("_rated"), F.col("motivation"))).alias("motivation"),
        F.count_if("_rated").alias("_n"))
    return both.filter("_n > 0 AND subCategory IS NOT NULL").select("competence", "motivation", "subCategory", "category")


def comp_amount(answers, questions, categories, rated_only: bool = False,
                excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    """How many people score above 3 per topic and category, and their shares.

    With `rated_only` the averages cover rated questions only, the counted answers all questions.
    """
    topics = _topics(questions, categories, False, excluded)
    if not rated_only:
        topics = topics.withColumn("_rated", F.lit(True))
    # Equal answers count once, but weigh in the averages as often as they were given. All aggregates of a person's category share one shuffle.
    base = (answers.filter("email IS NOT NULL").join(topics, "questionid")
            .select("email", "category", "subCategory", "motivation", "knowledge", "_rated").repartition("email", "category")
            .groupBy("email", "motivation", F.col("knowledge").alias("competence"), "subCategory", "category")
            .agg(F.count_if("_rated").alias("_n")))

    above = lambda c: F.count(F.when(F.col(c) > 3, 1))
    weighed = lambda c: (F.sum(F.col(c) * F.col("_n")), F.sum(F.when(F.col(c).isNotNull(), F.col("_n"))))
    (sum_m, n_m), (sum_k, n_k) = weighed("motivation"), weighed("competence")
    per_person = base.groupBy("email", "category", "subCategory").agg(
        above("motivation").alias("m"), above("competence").alias("k"), sum_m.alias("_sm"), n_m.alias("_nm"), sum_k.alias("_sk"), n_k.alias("_nk"),
        F.count(F.lit(1)).alias("_r"), F.sum("_n").alias("_n"))
    # A person's topics of a category are a list no longer than the category, so that one aggregate gives both counts.
    mean = lambda s, n: F.try_divide(F.sum(s), F.sum(n))
    person = (per_person.groupBy("email", "category")
              .agg(mean("_sm", "_nm").alias("_m"), mean("_sk", "_nk").alias("_k"), F.sum("_r").alias("_rows"), F.sum("_n").alias("_rated"),
                   F.collect_list(F.struct("subCategory", "m", "k")).alias("_topics"))
              .filter("_rated > 0"))
    # per person and category one row for the category and one per topic; both counts come from one aggregate
    level = lambda c: F.when(c > 3, 1).otherwise(0)
    own = F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("subCategory"), (level(F.col("_m")) * F.col("_rows")).alias("m"),
                   (level(F.col("_k")) * F.col("_rows")).alias("k"))
    topic = F.transform("_topics", lambda x: F.struct(F.lit(False).alias("whole"), x["subCategory"].alias("subCategory"), x["m"].alias("m"), x["k"].alias("k")))
    counts = person.select("category", F.inline(F.array_append(topic, own))).groupBy("category", "subCategory", "whole").agg(
        F.sum("m").alias("m"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("_people"))
    own_value = lambda c: F.max(F.when(F.col("whole"), F.col(c)))
    wide = counts.groupBy("category").agg(
        own_value("m").alias("motivationAmount"), own_value("k").alias("competenceAmount"), own_value("_people").alias("numEmails"),
        F.collect_list(F.when(~F.col("whole"), F.struct("subCategory", F.col("m").alias("subMotivationAmount"), F.col("k").alias("subCompetenceAmount")))).alias("_t"))
    share = lambda c, scale: (F.lit(scale) * F.col(c).cast("double") / F.col("numEmails").cast("double"))
    return wide.select("category", "motivationAmount", "competenceAmount", "numEmails", F.inline("_t")).select(
        "subCategory", "subMotivationAmount", share("subMotivationAmount", 100.0).alias("subMotivationPropotion"),
        "subCompetenceAmount", share("subCompetenceAmount", 100.0).alias("subCompetencePropotion"),
        "category", "motivationAmount", share("motivationAmount", 1.0).alias("motivationPropotion"),
        "competenceAmount", share("competenceAmount", 1.0).alias("competencePropotion"))


def employee_mot_comp(answers, questions, categories, rated_only: bool = True,
                      excluded: str = EXCLUDED_CATEGORY) -> DataFrame:
    """Every answer beside the person's averages in that category (rated questions only)."""
    topics = _topics(questions, categories, False, excluded)
    if not rated_only:
        topics = topics.withColumn("_rated", F.lit(True))
    rows = answers.join(topics, "questionid")
    rated = lambda c: F.avg(F.when(F.col("_rated"), F.col(c)))
    average = rows.groupBy("email", "category").agg(
        rated("motivation").alias("categoryMotivationAvg"), rated("knowledge").alias("categoryCompetenceAvg"), F.count_if("_rated").alias("_n")).filter("_n > 0")
    return lookup_join(rows, average.drop("_n"), ["email", "category"]).select(
        "email", "motivation", F.col("knowledge").alias("competence"), "subCategory", "category", "categoryMotivationAvg", "categoryCompetenceAvg")


def job_rotation(answers, questions, category_id: str) -> DataFrame:
    asked = questions.filter(F.col("categoryid") == category_id).select(
        F.col("id").alias("questionid"), "index", "text", "categoryid")
    return answers.join(asked, "questionid").select(
        "username", "email", "questionid", "customscalevalue", "guid", "index", "text", "categoryid")


# -- calendar ----------------------------------------------------------------------------


def events(calendar_events, today: str) -> DataFrame:
    """Distinct calendar events of the last three years."""
    start = F.timestamp_seconds("timestamp_from")
    since = F.add_months(F.to_date(F.lit(today)), -36)
    return calendar_events.filter(start > since.cast("timestamp")).select(
        "event_summary", start.alias("time_from"), F.timestamp_seconds("timestamp_to").alias("time_to")).distinct()
