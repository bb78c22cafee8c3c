"""§ reports maintained from additions. Each table lands in three parts; the view is refreshed after every one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports as R
from ..session import new_folder
from ..tables import views as V
from ..tables.store import TableStore
from . import reports  # noqa: F401  registers the SQL of the reports
from .registry import ORACLES, query
from .reports import rounded
from .roles import Roles


def land(t, store, view, rows, parts):
    """Write `rows` in parts and refresh the view after each, by its additions alone."""
    for n, part in enumerate(parts):
        store.write(rows.filter(part), view.table)
        done = V.refresh(store, view)
        if done != {"writes": 1, "full": n == 0}:
            raise RuntimeError(f"the refresh of {view.name} read {done}")
    return V.read(store, view)


@query("view_work_status", ORACLES["r_work_status"])
def view_work_status(t):
    store = TableStore(t.spark, new_folder(t.spark, "views"))
    parts = ["project_type < '2'", "project_type >= '2' AND project_type < '4'", "project_type >= '4'"]
    return land(t, store, R.WORK_STATUS, Roles(t).hours, parts)


@query("view_comp_mot_averages", ORACLES["r_comp_mot_averages"])
def view_comp_mot_averages(t):
    r, store = Roles(t), TableStore(t.spark, new_folder(t.spark, "views"))
    store.write_all({"competence_questions": r.questions, "competence_categories": r.categories})
    view = R.COMP_MOT_AVERAGES
    out = land(t, store, view, r.answers, ["motivation <= 2", "motivation > 2 AND motivation <= 4", "motivation > 4"])
    return rounded(out, "competence", "motivation").select("competence", "motivation", "subCategory", "category")


@query("view_history_sketches", """
    SELECT l_returnflag, count(*) AS n, true AS distinct_within, true AS median_within FROM lineitem GROUP BY l_returnflag""")
def view_history_sketches(t):
    """Distinct parts and the median price over all periods from one sketch per period, held against the exact values: 5 % and a rank of 3 %."""
    store = TableStore(t.spark, new_folder(t.spark, "views"))
    periods = V.View("price_history", "lines", ("l_returnflag", "period"),
                     {"n": ("count", "l_partkey"), "parts": ("distinct", "l_partkey"), "price": ("median", "l_extendedprice")},
                     lambda delta, read: delta.withColumn("period", F.date_format("l_shipdate", "yyyyMM")))
    land(t, store, periods, t.lineitem, ["l_linenumber = 1", "l_linenumber IN (2, 3)", "l_linenumber > 3"])
    log = V._log(store, periods)
    stored = store.read_folders([f"{log.folder}/{w}" for w in log.latest().writes])
    whole = V.View("price_history", "lines", ("l_returnflag",), periods.measures)
    merged = whole.values(whole.merged(stored.drop("period"), stored.drop("period").limit(0)))
    exact = t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("exact"))
    ranks = t.lineitem.join(merged.select(F.col("l_returnflag").alias("flag"), "price"), F.col("l_returnflag").eqNullSafe(F.col("flag"))).groupBy("l_returnflag").agg(
        F.avg((F.col("l_extendedprice") < F.col("price")).cast("int")).alias("below"), F.avg((F.col("l_extendedprice") <= F.col("price")).cast("int")).alias("upto"))
    return merged.join(exact, "l_returnflag").join(ranks, "l_returnflag").select(
        "l_returnflag", "n", (F.abs(F.col("parts") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_within"),
        ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_within"))
