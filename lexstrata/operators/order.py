"""Positions and running values in reading order, without one task for a whole file.

A file may hold a third of all rows, so nothing is ordered by file alone: rows are ranked within their page, pages are
ranked on one row each, and running values combine those of the page with those of the pages before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank of the first row that no page could have.
NO_PAGE = 2_147_483_647


def positions(df: DataFrame, ties: tuple[str, ...] = ("ordine", "block_id"), file: str = "file") -> DataFrame:
    """``df`` with seq, the place of a row in its file from 0: by page (null last), page_order (null last), ``ties``."""
    paged = df.withColumn("_page", F.coalesce(F.col("page"), F.lit(NO_PAGE)))
    within = Window.partitionBy(file, "_page").orderBy(F.col("page_order").asc_nulls_last(), *ties)
    pages = paged.groupBy(file, "_page").agg(F.count(F.lit(1)).alias("_rows"))
    before = pages.withColumn("_before", F.sum("_rows").over(Window.partitionBy(file).orderBy("_page")) - F.col("_rows")).drop("_rows")
    ranked = paged.withColumn("_place", F.row_number().over(within) - 1)
    return ranked.join(before, [file, "_page"]).withColumn("seq", (F.col("_before") + F.col("_place")).cast("long")).drop("_before", "_place")


def running_last(df: DataFrame, marks: dict[str, Column], inclusive: bool = True, file: str = "file") -> DataFrame:
    """``df`` (with seq and _page of ``positions``) with, for each mark, the seq of the last row so far that has it.

    Null where there is none. ``inclusive`` counts the row itself.
    """
    flagged = df.withColumns({f"_is_{name}": F.when(mark, F.col("seq")) for name, mark in marks.items()})
    within = Window.partitionBy(file, "_page").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    pages = flagged.groupBy(file, "_page").agg(*(F.max(f"_is_{n}").alias(f"_top_{n}") for n in marks))
    earlier = Window.partitionBy(file).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    carried = pages.select(file, "_page", *(F.max(f"_top_{n}").over(earlier).alias(f"_carry_{n}") for n in marks))
    local = flagged.withColumns({f"_local_{n}": F.max(f"_is_{n}").over(within) for n in marks})
    joined = local.join(carried, [file, "_page"])
    out = joined.withColumns({n: F.coalesce(f"_local_{n}", f"_carry_{n}") for n in marks})
    return out.drop(*(f"{p}_{n}" for n in marks for p in ("_is", "_local", "_carry")))
