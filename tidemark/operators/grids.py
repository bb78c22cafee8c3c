"""Cell grids (uploaded sheets). A grid is one row holding `ARRAY<ARRAY<STRING>>`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to_null


def _used_rows(grid: Column) -> Column:
    flags = F.transform(grid, lambda row, i: F.when(F.exists(row, lambda c: c != ""), i))
    return F.array_compact(flags)


def bounds(grid) -> Column:
    """Smallest box around all non-empty cells, zero-based and inclusive; nulls for a blank grid."""
    grid = F.col(grid) if isinstance(grid, str) else grid
    rows = _used_rows(grid)
    columns = F.array_compact(F.flatten(F.transform(
        grid, lambda row: F.transform(row, lambda c, i: F.when(c != "", i)))))
    return F.struct(F.array_min(rows).alias("top"), F.array_max(rows).alias("bottom"),
                    F.array_min(columns).alias("left"), F.array_max(columns).alias("right"))


def cropped(grid: Column, box: Column) -> Column:
    width = box["right"] - box["left"] + 1
    inside = F.slice(grid, box["top"] + 1, box["bottom"] - box["top"] + 1)
    return F.when(box["top"].isNotNull(),
                  F.transform(inside, lambda row: F.slice(row, box["left"] + 1, width)))


def grid_to_rows(df: DataFrame, meta: list[str], grid_col: str) -> DataFrame:
    """One row per data line: `headers` in the grid's order, `row_no` and `cells`, a map from header to value (blank is null).

    When two columns share a header, the right one wins. Blank grids give no rows.
    """
    boxed = df.select(*meta, F.col(grid_col).alias("_g"), bounds(grid_col).alias("_box"))
    cut = boxed.filter("_box.top IS NOT NULL").select(*meta, cropped(F.col("_g"), F.col("_box")).alias("_c"))
    # Headers in name order: the last of equal names is the one whose right neighbour differs.
    heads = cut.select("*", F.array_sort(F.transform(F.element_at("_c", 1), lambda name, i: F.struct(
        F.coalesce(name, F.lit("")).alias("name"), i.alias("at")))).alias("_h"))
    kept = heads.select(*meta, "_c", F.filter(
        "_h", lambda x, k: ~F.get(F.col("_h"), k + 1)["name"].eqNullSafe(x["name"])).alias("_k"))
    ordered = F.array_sort(F.transform("_k", lambda x: F.struct(x["at"].alias("at"), x["name"].alias("name"))))
    kept = kept.select("*", F.transform(ordered, lambda x: x["name"]).alias("headers"))
    lines = kept.select(*meta, "headers", "_k", F.posexplode(
        F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(0)))).alias("row_no", "_row"))
    pairs = F.transform("_k", lambda x: F.struct(x["name"], blank_to_null(F.get(F.col("_row"), x["at"]))))
    return lines.select(*meta, "headers", "row_no", F.map_from_entries(pairs).alias("cells"))


def sheet_columns(rows: DataFrame, headers: list[str]) -> DataFrame:
    """One sheet's rows as a plain table. Headers equal but for case get a running number."""
    columns, seen = [], {}
    for h in headers:
        n = seen[h.lower()] = seen.get(h.lower(), 0) + 1
        name = h if h else "column"
        columns.append(F.col("cells").getItem(h).alias(name if n == 1 else f"{name}_{n}"))
    return rows.select(columns)
