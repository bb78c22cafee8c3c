"""The reports by name: which tables each reads, how it is computed and in which order it is shown."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports as R

MAPPING = "customer_mapping"
ANSWERS = ("competence_answers", "competence_questions", "competence_categories")
JOB_ROTATION_CATEGORY = "bdcfb7c4-12ed-4191-8e98-64be3e68f2c8"  # Fixed value of the report.


@dataclass(frozen=True)
class Report:
    tables: tuple[str, ...]
    build: Callable
    order: tuple = ()


def plain(f, **options):
    """A report that does not depend on the day."""
    return lambda today, *tables: f(*tables, **options)


EMPLOYEES, EDUCATION, HOURS = "cv_partner_employees", "cv_partner_education", "ubw_customer_per_resource"
DIRECTORY, PROJECTS = "active_directory", "ubw_per_project_data"
JOBS, SKILLS = "cv_partner_work_experience", "cv_partner_technology_skills"
ENGAGEMENTS, LANGUAGES = "cv_partner_project_experience", "cv_partner_languages"

# The names of the reports, and the tables each reads.
CATALOGUE: dict[str, Report] = {
    "ubwExperience": Report(("ubw_experience", HOURS, DIRECTORY), plain(R.experience)),
    "employeeInformation": Report((EMPLOYEES, EDUCATION, HOURS, MAPPING, DIRECTORY), plain(R.employee_information), ("navn",)),
    "ageDistribution": Report((EMPLOYEES,), lambda d, e: R.age_distribution(e, d.year), ("age",)),
    "employeeDataUBW": Report((PROJECTS, HOURS, DIRECTORY), plain(R.employee_hours)),
    "fagActivity": Report(("ubw_fagtimer",), plain(R.activity), ("year", "week")),
    "employeeSkills": Report((EMPLOYEES, LANGUAGES, SKILLS, ENGAGEMENTS), plain(R.employee_skills)),
    "employeeImages": Report(("cv_partner_employee_images",), plain(R.passthrough)),
    "ageDistributionGroups": Report((EMPLOYEES,), lambda d, e: R.age_groups(e, d.year), ("age_group",)),
    "basicEmployeeInformation": Report((EMPLOYEES, HOURS, MAPPING), plain(R.basic_employee), ("name",)),
    "allProjectsOverview": Report((PROJECTS, MAPPING), plain(R.all_projects)),
    "newCategories": Report(ANSWERS[1:], plain(R.categories)),
    "projectStatus": Report((EMPLOYEES,), plain(R.project_status)),
    "newCompetenceMotivationAverages": Report(ANSWERS, plain(R.comp_mot_averages)),
    "competenceAmountAggregated": Report(ANSWERS, plain(R.comp_amount)),
    "employeesWithPrimaryCustomer": Report((EMPLOYEES, HOURS, MAPPING), plain(R.primary_customer), ("navn",)),
    "employeeProfileInformation": Report((EMPLOYEES, EDUCATION, DIRECTORY), plain(R.profile), ("name",)),
    "countEmployees": Report((EMPLOYEES,), plain(R.count_employees)),
    "fullProfile4": Report((EMPLOYEES, EDUCATION, DIRECTORY), plain(R.profile_unmatched), ("name",)),
    "employeeCustomers": Report((EMPLOYEES, HOURS, MAPPING), plain(R.employee_customers)),
    "workExperienceDistributedInYears": Report(
        (EMPLOYEES, JOBS), lambda d, e, j: R.experience_years(e, j, d.isoformat()), ("-count",)),
    "workExperience": Report((JOBS, EMPLOYEES), plain(R.work_experience)),
    "debug-marie": Report(ANSWERS, plain(R.comp_amount, rated_only=True)),
    "fullProfile7": Report((EMPLOYEES, EDUCATION, DIRECTORY), plain(R.profile), ("name",)),
    "newCompetenceAverage": Report(ANSWERS, plain(R.topic_average, measure="knowledge")),
    "averageCompetenceAndMotivation": Report(ANSWERS, plain(R.avg_comp_mot)),
    "filteredCategories": Report(ANSWERS[1:], plain(R.categories)),
    "yearsSinceSchoolDist": Report((EMPLOYEES, EDUCATION), lambda d, e, s: R.years_since_school(e, s, d.year), ("-count",)),
    "degreeDist": Report((EMPLOYEES, EDUCATION), plain(R.degree_distribution)),
    "projectExperience": Report((ENGAGEMENTS, EMPLOYEES), plain(R.project_experience)),
    "fagEvents": Report(("google_calendar_events",), lambda d, e: R.events(e, d.isoformat())),
    "employeeMotivationAndCompetence": Report(ANSWERS, plain(R.employee_mot_comp)),
    "jobRotationInformation": Report(ANSWERS[:2], lambda d, a, q: R.job_rotation(a, q, JOB_ROTATION_CATEGORY)),
    "perProject": Report((PROJECTS, MAPPING), plain(R.per_project)),
    "newMotivationAverage": Report(ANSWERS, plain(R.topic_average, measure="motivation")),
    "accountManager": Report(("account_managers",), plain(R.account_manager)),
    "employeeMotivationAndCompetence2": Report(ANSWERS, plain(R.employee_mot_comp)),
    "employeeWorkStatus": Report((HOURS,), plain(R.work_status)),
}


REGISTRY = ("name STRING, queryString STRING, tables ARRAY<STRING>, dataProtection INT, created STRING, lastUsed STRING, "
            "lastCacheUpdate STRING")


def run_report(name: str, read: Callable[[str], DataFrame], today: date, ordered: bool = False) -> DataFrame:
    """One report over `read(table)`; `ordered` sorts the result for display (a global sort)."""
    report = CATALOGUE[name]
    df = report.build(today, *[read(table) for table in report.tables])
    if ordered and report.order:
        df = df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in report.order])
    return df


def registry(spark: SparkSession, levels: Callable[[str], int], created: str) -> DataFrame:
    """The catalogue as registry rows; a report's level is the highest of its tables, at least 3.

    The SQL of a built-in report selects from the view of its name, which `stored_sql` in `registry.py` defines.
    """
    rows = [(name, f"SELECT * FROM `{name}`", list(r.tables), max(3, *map(levels, r.tables)), created, None, None)
            for name, r in CATALOGUE.items()]
    return spark.createDataFrame(rows, REGISTRY)
