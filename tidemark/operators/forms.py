"""Form answers: question × sub-question × answer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_name, epoch

# The question types of the form service.
GRID_TYPES = ["GRID", "CHECKBOX_GRID"]
CHOICE_TYPES = ["MULTIPLE_CHOICE", "CHECKBOX", "LIST"]
TEXT_TYPES = ["FILE_UPLOAD", "TEXT", "PARAGRAPH_TEXT", "DATE", "TIME", "SCALE"]


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "STRING")


def _items(value: Column) -> Column:
    """The elements of a list, or the value itself as the only one."""
    return F.coalesce(F.try_variant_get(value, "$", "ARRAY<VARIANT>"), F.array(value))


def answer_list(response: Column) -> Column:
    """An answer (a VARIANT: scalar or list) as an array of texts; a missing answer is one ''.

    The JSON value itself says whether it is a list, so a text may begin with a bracket or a quote.
    """
    missing = response.isNull() | F.is_variant_null(response)
    return F.when(missing, F.array(F.lit(""))).otherwise(F.transform(_items(response), _text))


def _parts(question: Column) -> Column:
    """(sub question, answer) pairs of one question."""
    response = question["answer"]["response"]
    answers = answer_list(response)
    rows = question["typeData"]["rows"]
    missing = F.array(F.struct(F.get(rows, F.lit(0)).alias("sub"), F.lit("").alias("answer")))
    lines = F.flatten(F.transform(_items(response), lambda line, i: F.transform(
        _items(line), lambda x: F.struct(F.get(rows, i).alias("sub"), _text(x).alias("answer")))))
    grid = F.when(response.isNull() | F.is_variant_null(response), missing).otherwise(lines)
    flat = F.transform(answers, lambda a: F.struct(F.lit("").alias("sub"), a.alias("answer")))
    return (F.when(question["type"].isin(GRID_TYPES), grid)
            .when(question["type"].isin(CHOICE_TYPES + TEXT_TYPES), flat)
            .otherwise(F.raise_error(F.concat(F.lit("Question type is not supported: "), question["type"]))))


def quiz_grade(answer: Column, choices: Column) -> Column:
    """Whether a given answer is marked correct; null for an answer that is no choice."""
    hit = F.filter(choices, lambda c: c["value"] == answer)
    return F.try_element_at(F.transform(hit, lambda c: c["isCorrect"]), F.lit(-1))


def form_rows(envelopes: DataFrame) -> DataFrame:
    """One row per answer of every response of every landed form."""
    response = envelopes.select(
        F.col("metadata.timestamp").alias("time_uploaded"),
        clean_name("data.tableName").alias("form_name"),
        F.coalesce("data.user", F.lit("undefined")).alias("uploaded_by_user"),
        F.explode("data.responses").alias("r"))
    question = response.select("time_uploaded", "form_name", "uploaded_by_user", "r.id", "r.timestamp", "r.isQuiz",
                               F.explode("r.questions").alias("q"))
    part = question.select("*", F.posexplode(_parts(F.col("q"))).alias("pos", "part"))
    graded = F.col("q.type").isin(CHOICE_TYPES) & F.col("isQuiz")
    return part.select(
        F.col("q.title").alias("question_title"), F.col("q.type").alias("type"),
        F.col("q.helpText").alias("help_text"), F.col("id").alias("responder"),
        epoch("timestamp").alias("timestamp"), F.col("isQuiz").alias("is_quiz"),
        F.col("part.sub").alias("sub_question text"), F.col("part.answer").alias("answer"),
        F.coalesce("q.typeData.feedbackCorrect", F.lit("")).alias("feedback_correct"),
        F.coalesce("q.typeData.feedbackIncorrect", F.lit("")).alias("feedback_incorrect"),
        F.when(F.col("pos") == 0, F.coalesce("q.typeData.points", F.lit(0))).otherwise(0).alias("available_points"),
        F.when(graded, quiz_grade(F.col("part.answer"), F.col("q.typeData.choices"))).alias("is_correct"),
        "form_name", "uploaded_by_user", "time_uploaded")
