"""Lines that a site repeats on too many of its pages are boilerplate and go.

A line's share is the number of the host's pages that contain it, divided by the host's number of
pages.  Lines are compared as they stand; lines without a word are never boilerplate.  One rule holds for hosts of
every size: the share is above the ratio, and at least ``min_pages`` pages hold the line, so that on a host of a
few pages two pages alike are not enough.

A null host is the host ''.  A null text stays null, and its page counts for the host; an empty text
stays empty.  A line that a page repeats counts once for the page, and all its copies go.  Repeated
rows are pages of their own.  Texts and lines of any length are whole.  Other columns pass through whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import fresh, stored


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(docs: DataFrame, host: Column, text: Column, ratio: float, min_pages: int) -> DataFrame:
    """Hash values of each host's boilerplate lines: (host, lines), one row per host that has any.

    A host has at most (mean number of different lines of a page) / ratio of them.
    """
    pages = docs.select(
        F.coalesce(host, F.lit("")).alias("host"),
        F.array_distinct(F.transform(F.filter(_lines(text), _has_word), lambda x: F.xxhash64(x))).alias("lines"),
    )
    # Explicit, so that a host with a third of all pages is counted in each task before the shuffle.
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = counts.filter(F.col("n") >= min_pages)
    common = counts.join(totals, "host").filter(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame,
    host: str | Column = "source",
    text: str = "text",
    ratio: float = 0.05,
    min_pages: int = 3,
    dropped: str | None = None,
) -> DataFrame:
    """``docs`` without the lines on more than ``ratio`` of their host's pages, and on ``min_pages`` of them at least.

    ``dropped`` names a column for the number of lines that went; one of that name is replaced.
    """
    host = F.col(host) if isinstance(host, str) else host
    found = stored(boilerplate(docs, host, F.col(text), ratio, min_pages), "boilerplate")
    h, known, lines = fresh(docs, "host", "known", "lines")
    # The stored side has a measured size: Spark broadcasts it if small, and else splits hot hosts.
    joined = docs.withColumn(h, F.coalesce(host, F.lit(""))).join(
        found.toDF(h, known), h, "left"
    )
    left = F.filter(_lines(F.col(text)), lambda x: ~F.array_contains(F.col(known), F.xxhash64(x)))
    joined = joined.withColumn(lines, F.when(F.col(known).isNotNull(), left))
    gone = F.coalesce(F.size(_lines(F.col(text))) - F.size(lines), F.lit(0))
    columns = {text: F.coalesce(F.array_join(lines, "\n"), F.col(text))}
    out = [columns.get(c, F.col(c)).alias(c) for c in docs.columns if c != dropped]
    if dropped:
        out.append(gone.cast("long").alias(dropped))
    return joined.select(*out)
