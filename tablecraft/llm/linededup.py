"""Line deduplication by site-relative frequency.

Pages are grouped by host. The share of a line is the number of the host's distinct pages
that contain it, divided by the host's distinct pages; lines whose share reaches the
boilerplate ratio are dropped from every page of that host. Exact copies of a page count
once, so a copied page does not make its own lines boilerplate (removing copies is
another operator's work). Only hashes of lines are shuffled; counting is a two-step
distinct aggregation, so a line or host with any number of pages is combined before it
meets in one task. A host has at most (lines per page) / ratio dropped lines, and that
short list joins its pages; Spark broadcasts it when its measured size allows.

Lines are parted by newline and compared without leading and trailing blanks; blank lines
are kept. Edge cases: null text stays null and empty text empty; a null host is a host of
its own; a line counts once per page; lines on fewer than ``min_pages`` pages stay
whatever their share, so hosts of a few pages keep theirs. Empty table: empty result.
Other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.frames import stored, unused


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): hashes of the lines to drop on each host that has any."""
    text = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).where("text is not null")
    page = F.xxhash64("text").alias("page")
    total = text.select("host", page).groupBy("host").agg(F.count_distinct("page").alias("total"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), _line_hash))
    seen = text.select("host", page, F.explode(lines).alias("line"))
    often = seen.groupBy("host", "line").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= min_pages)
    total = total.withColumnRenamed("host", "_host")
    flagged = often.join(total, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("n") / F.col("total") >= ratio)
    return flagged.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host_col: str, text_col: str = "text", ratio: float = 0.02, min_pages: int = 5,
                     dropped_col: str | None = None) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text_col``; ``dropped_col`` adds
    the number of dropped lines."""
    host, drop = unused(pages, "host"), unused(pages, "lines")
    flagged = stored(boilerplate(pages, host_col, text_col, ratio, min_pages), "boilerplate")
    flagged = flagged.select(F.col("host").alias(host), F.col("lines").alias(drop))
    joined = pages.join(flagged, F.col(host_col).eqNullSafe(F.col(host)), "left")
    split = F.split(text_col, "\n")
    kept = F.filter(split, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(drop), _line_hash(x)))
    new_text = F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    out = [new_text.alias(c) if c == text_col else F.col(c) for c in pages.columns]
    if dropped_col:
        n = F.when(F.col(drop).isNull() | F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(split) - F.size(kept))
        out.append(n.cast("long").alias(dropped_col))
    return joined.select(*out)
