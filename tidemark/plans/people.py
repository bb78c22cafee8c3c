"""Source jobs about people: directory, hours, experience, activity, CVs, competence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (common_name, closed_period, fill_text, float_or_zero, int_or_zero, join_tag_list,
                               pick_locale, reindex, stable_guid, years_since)
from ..operators.aggregates import project_rollup, snapshot_count
from ..operators.joins import new_rows, self_manager
from ..operators.windows import first_by, keep_latest_periods, merge_new_with_old, weight_rank
from ..sources.envelopes import with_meta_time
from .job import job


# The column names of the feeds and of the stored tables in this module.


def directory(users: DataFrame, branch: str = "branch") -> DataFrame:
    """The person directory from account records; service, external and deleted accounts are left out.

    Managers are looked up among all accounts by their distinguished name.
    """
    known = self_manager(users, "distinguishedName", "managerDistinguishedName", "primaryEmailAddress",
                         "samAccountName")
    people = known.filter(~F.col("isServiceUser") & ~F.col("isExternalUser") & ~F.col("isDeleted"))
    return fill_text(people.select(
        stable_guid("samAccountName").alias("guid"), F.col("primaryEmailAddress").alias("email"), "displayName",
        F.col("samAccountName").alias("alias"), "company", F.col(branch).alias("branch"),
        common_name("distinguishedName").alias("distinguished_name"),
        common_name("manager").alias("manager"), "manager_email"))


@job("STRUCT<trigger STRING>", overwrite=True, purge_versions=True, historical=["ad_number_of_employees"])
def directory_tables(envelopes, context):
    """The envelope only triggers; the stored person directory is the input."""
    people = context.options["directory"]
    return {
        "active_directory": people.select("guid", "displayName", "email", "manager", "manager_email"),
        "ad_number_of_employees": snapshot_count(people, int(context.now.timestamp())),
    }


HOURS = """ARRAY<STRUCT<tab STRING, reg_period STRING, used_hrs STRING, resource_id STRING, xr1project STRING,
    work_order STRING, xwork_order STRING, xr0work_order STRING>>"""


def typed_hours(envelopes: DataFrame) -> DataFrame:
    """Typed records of all rows; `_worked` marks the complete ones with positive hours."""
    rows = with_meta_time(envelopes).select(
        "reg_period", float_or_zero("used_hrs").alias("used_hrs"), F.lower("resource_id").alias("alias"),
        F.col("xr1project").alias("project_type"), "work_order", F.col("xwork_order").alias("work_order_description"),
        F.col("xr0work_order").alias("customer"), "time")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rows.columns])
    return rows.withColumn("_worked", complete & ~F.isnan("used_hrs") & (F.col("used_hrs") > 0))


@job(HOURS, overwrite=True, purge_versions=True, historical=["ubw_per_project_data"],
     person_tables={"ubw_customer_per_resource": "alias"}, parse_once=True, stage=typed_hours)
def hours_per_resource(rows, context):
    work = rows.filter("_worked").drop("_worked")
    ranked = weight_rank(work, "alias", "used_hrs", ["work_order", "project_type", "reg_period"])
    # All projects of a run carry the run's one time stamp.
    stamp = rows.agg(F.min("time"))
    projects = project_rollup(work, 0).withColumn("timestamp", stamp.scalar())
    current = ranked.drop("used_hrs")
    old = context.existing("ubw_customer_per_resource")
    if old is not None:
        kept = keep_latest_periods(old.drop("guid"), "reg_period", context.options.get("weeks", 4))
        current = merge_new_with_old(current, kept, ["time"])
    return {"ubw_customer_per_resource": current, "ubw_per_project_data": projects}


EXPERIENCE = """ARRAY<STRUCT<resource_id STRING, name STRING, r0_x0023_exami0_x0023_612 STRING,
    xr0_x0023_e1_x0023_611_x0023_U00 STRING, date_from STRING>>"""


@job(EXPERIENCE, overwrite=True, purge_versions=True)
def experience(envelopes, context):
    rows = reindex(with_meta_time(envelopes), {c: "string" for c in (
        "resource_id", "name", "r0_x0023_exami0_x0023_612", "xr0_x0023_e1_x0023_611_x0023_U00", "date_from")})
    year = F.col("r0_x0023_exami0_x0023_612")
    return {"ubw_experience": rows.select(
        F.col("resource_id").alias("alias"), "name", years_since(year, context.now.year).alias("experience"),
        year.alias("examination_year"), F.col("xr0_x0023_e1_x0023_611_x0023_U00").alias("grade"),
        F.col("date_from").alias("start_year"))}


def closed_hours(rows: DataFrame, now) -> DataFrame:
    """Records of completed periods, as they are landed."""
    year, week, _ = now.isocalendar()
    return rows.filter(closed_period("reg_period", "tab", year, week))


@job("ARRAY<STRUCT<tab STRING, reg_period STRING, used_hrs STRING>>")
def activity_hours(envelopes, context):
    """First value per period in text order; periods already stored are never rewritten."""
    rows = with_meta_time(envelopes, as_float=True).select("time", "reg_period", "used_hrs")
    first = first_by(rows, ["reg_period"], ["used_hrs", "time"], ["time", "used_hrs"])
    return {"ubw_fagtimer": new_rows(first, context.existing("ubw_fagtimer"), ["reg_period"])}


NO = "STRUCT<no STRING>"
CV = f"""ARRAY<STRUCT<user_id STRING, default_cv_id STRING, cv_link STRING, image_key STRING, cv STRUCT<
    navn STRING, email STRING, telefon STRING, born_year STRING, nationality STRUCT<int STRING>,
    place_of_residence STRUCT<int STRING>, twitter STRING, title {NO},
    educations ARRAY<STRUCT<degree {NO}, description {NO}, school {NO}, month_from STRING, month_to STRING,
        year_from STRING, year_to STRING>>,
    blogs ARRAY<STRUCT<long_description {NO}, month STRING, name {NO}, url STRING, year STRING>>,
    courses ARRAY<STRUCT<long_description {NO}, name {NO}, program {NO}, year STRING>>,
    key_qualifications ARRAY<STRUCT<long_description {NO}, label {NO}, tag_line {NO}>>,
    languages ARRAY<STRUCT<name {NO}, level {NO}>>,
    project_experiences ARRAY<STRUCT<customer {NO}, description {NO}, long_description {NO}, industry {NO},
        project_experience_skills ARRAY<STRUCT<tags {NO}>>, roles ARRAY<STRUCT<name {NO}>>,
        percent_allocated STRING, year_from STRING, year_to STRING, month_from STRING, month_to STRING>>,
    technologies ARRAY<STRUCT<category {NO}, technology_skills ARRAY<STRUCT<tags {NO}>>>>,
    work_experiences ARRAY<STRUCT<description {NO}, employer {NO}, long_description {NO}, month_from STRING,
        month_to STRING, year_from STRING, year_to STRING>>>>>"""


def cv_section(people: DataFrame, section: str, columns: list[str], translated=(), numbers=(), tags=None) -> DataFrame:
    """One CV section as a table; persons without the section give no rows."""
    tags = tags or {}
    rows = people.select("user_id", F.inline(f"cv.{section}"))

    def cell(c):
        if c in translated:
            return pick_locale(c).alias(c)
        if c in numbers:
            return int_or_zero(c).alias(c)
        if c in tags:
            return join_tag_list(c, tags[c]).alias(c)
        return F.col(c)

    return rows.select("user_id", *[cell(c) for c in columns])


SPAN = ["month_from", "month_to", "year_from", "year_to"]


@job(CV, overwrite=True, purge_versions=True, person_tables={"cv_partner_employees": "email"}, parse_once=True)
def employees_cv(envelopes, context):
    people = envelopes.select(F.inline("data"))
    employees = fill_text(people.select(
        "user_id", "default_cv_id", F.col("cv_link").alias("link"), "cv.navn", "cv.email", "cv.telefon",
        int_or_zero("cv.born_year").alias("born_year"), F.col("cv.nationality.int").alias("nationality"),
        F.col("cv.place_of_residence.int").alias("place_of_residence"), "cv.twitter",
        F.col("cv.title.no").alias("title"), "image_key"))
    return {
        "cv_partner_employees": employees,
        "cv_partner_education": cv_section(
            people, "educations", ["degree", "description", "month_from", "month_to", "school", "year_from", "year_to"],
            ["degree", "description", "school"], SPAN),
        "cv_partner_blogs": cv_section(
            people, "blogs", ["long_description", "month", "name", "url", "year"], ["long_description", "name"],
            ["month", "year"]),
        "cv_partner_courses": cv_section(
            people, "courses", ["long_description", "name", "program", "year"],
            ["long_description", "name", "program"]),
        "cv_partner_key_qualification": cv_section(
            people, "key_qualifications", ["long_description", "label", "tag_line"],
            ["long_description", "label", "tag_line"]),
        "cv_partner_languages": cv_section(people, "languages", ["name", "level"], ["name", "level"]),
        "cv_partner_project_experience": cv_section(
            people, "project_experiences",
            ["customer", "description", "long_description", "industry", "project_experience_skills", "roles",
             "percent_allocated", "year_from", "year_to", "month_from", "month_to"],
            ["customer", "long_description", "description", "industry"], SPAN + ["percent_allocated"],
            {"project_experience_skills": "tags", "roles": "name"}),
        "cv_partner_technology_skills": cv_section(
            people, "technologies", ["category", "technology_skills"], ["category"], (), {"technology_skills": "tags"}),
        "cv_partner_work_experience": cv_section(
            people, "work_experiences",
            ["description", "employer", "month_from", "month_to", "year_from", "year_to", "long_description"],
            ["description", "employer", "long_description"], SPAN),
    }


COMPETENCE = """STRUCT<users ARRAY<STRUCT<username STRING, attributes ARRAY<STRUCT<Name STRING, Value STRING>>>>,
    answers ARRAY<STRUCT<username STRING, email STRING, answers ARRAY<STRUCT<question STRUCT<id STRING>,
        knowledge DOUBLE, motivation DOUBLE, updatedAt STRING, customScaleValue DOUBLE>>>>,
    catalogs ARRAY<STRUCT<id STRING, label STRING>>,
    questions ARRAY<STRUCT<id STRING, topic STRING, type STRING, categoryid STRING, text STRING, index INT>>,
    categories ARRAY<STRUCT<index INT, text STRING, description STRING, id STRING>>>"""


@job(COMPETENCE, overwrite=True, purge_versions=True,
     person_tables={"competence_users": "email", "competence_answers": "email"}, parse_once=True)
def competence(envelopes, context):
    users = envelopes.select(F.inline("data.users")).select("username", F.inline("attributes"))
    answers = envelopes.select(F.inline("data.answers")).select("username", "email", F.inline("answers"))
    return {
        "competence_users": users.select("username", F.col("Value").alias("email")),
        "competence_answers": answers.select("username", "email", F.col("question.id").alias("questionId"),
                                             "knowledge", "motivation", "updatedAt", "customScaleValue"),
        "competence_catalogs": envelopes.select(F.inline("data.catalogs")),
        "competence_questions": envelopes.select(F.inline("data.questions")),
        "competence_categories": envelopes.select(F.inline("data.categories")),
    }
