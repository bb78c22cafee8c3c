"""Source jobs of user uploads: forms and sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_name
from ..operators.forms import form_rows
from ..operators.grids import bounds, grid_to_rows, sheet_columns
from ..operators.joins import lookup_join
from ..tables.store import TableStore
from .job import job

FORM = """STRUCT<tableName STRING, user STRING, responses ARRAY<STRUCT<respondent STRING, timestamp STRING, id STRING,
    isQuiz BOOLEAN, questions ARRAY<STRUCT<title STRING, helpText STRING, id BIGINT, type STRING,
    answer STRUCT<response VARIANT>, typeData STRUCT<choices ARRAY<STRUCT<value STRING, isCorrect BOOLEAN>>,
    rows ARRAY<STRING>, feedbackCorrect STRING, feedbackIncorrect STRING, points INT>>>>>>"""


@job(FORM, partitions={"google_forms_data": ["form_name", "uploaded_by_user"]})
def forms(envelopes, context):
    return {"google_forms_data": form_rows(envelopes)}


SHEET = "STRUCT<tableName STRING, values ARRAY<ARRAY<STRING>>, user STRING>"


def sheet_name() -> Column:
    user = F.coalesce("data.user", F.lit("undefined"))
    return clean_name(F.concat(user, F.lit("-"), F.col("data.tableName")))


def sheet_metadata(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(F.coalesce("data.user", F.lit("undefined")).alias("uploaded_by_user"),
                            F.col("metadata.timestamp").alias("time_added"),
                            sheet_name().alias("inserted_tables"))


SHEETS = "google_sheets_rows"


def newest_sheets(envelopes: DataFrame) -> DataFrame:
    """The data lines of the newest upload of every sheet: sheet, headers in the sheet's order, row_no, cells as a map.

    An upload is known by its time and content, so two uploads of equal time are not mixed (the larger hash counts). Uploads without
    a data line do not replace anything.
    """
    grid = F.col("data.values")
    uploads = envelopes.select(sheet_name().alias("sheet"), F.col("metadata.timestamp").alias("t"),
                               F.xxhash64(F.to_json("data")).alias("upload"), grid.alias("g"), bounds(grid).alias("box"))
    uploads = uploads.filter("box.bottom > box.top").drop("box")
    newest = uploads.groupBy("sheet").agg(F.max(F.struct("t", "upload")).alias("n")).select("sheet", "n.t", "n.upload")
    found = lookup_join(uploads, newest, ["sheet", "t", "upload"], "left_semi", nulls=True)
    # the same upload landed twice is one
    once = found.groupBy("sheet").agg(F.first("g").alias("g"))
    return grid_to_rows(once, ["sheet"], "g")


@job(SHEET, overwrite=True, parse_once=True)
def sheets(envelopes, context):
    """The lines of all uploaded sheets in one table ordered by sheet, whatever their number, plus the metadata table.

    Sheets that are not uploaded again stay as they are; `read_sheet` gives one of them as a plain table.
    """
    lines, old = newest_sheets(envelopes), context.existing(SHEETS)
    if old is not None:
        lines = lines.unionByName(lookup_join(old, lines.select("sheet").distinct(), ["sheet"], "left_anti", nulls=True))
    # a sheet lies in few files and few row groups, so that a filter on its name reads little
    lines = lines.hint("rebalance", F.col("sheet")).sortWithinPartitions("sheet", "row_no")
    return {SHEETS: lines, "google_sheets_metadata": sheet_metadata(envelopes)}


def read_sheet(store: TableStore, name: str) -> DataFrame:
    """One stored sheet with its own columns, in the order of the sheet."""
    rows = store.read(SHEETS).filter(F.col("sheet") == name)
    head = rows.select("headers").first()
    if head is None:
        raise KeyError(f"no sheet named {name}")
    return sheet_columns(rows, head["headers"])
