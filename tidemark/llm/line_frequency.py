"""Line dedup by site-relative frequency: lines on too many pages of their site are boilerplate.

Defined results: copies of a page (equal texts of one site) count as one page, so a page copied
often does not look like boilerplate. Rows without a site form one site of their own. Lines that
are empty or blank are never dropped. A null text stays null with 0 lines; an empty text is one
empty line. Repeated rows and repeated ids each get their own, equal result. Other columns pass
through whatever their names; only ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import digest16, unpacked, whole_row

#: A line is boilerplate on more than this share of its site's pages, ...
RATIO = 0.08
#: ... if it repeats at all: apart from that the ratio decides on sites of every size.
MIN_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate_lines(docs: DataFrame, text: str, host: str, ratio: float, min_pages: int) -> DataFrame:
    """``host, line_key, n_pages, n_host_pages`` of the lines that exceed the ratio.

    Each page gives each of its lines once, and equal pages of a site are merged before counting, so
    a line on a third of all pages leaves every map task as one partial count per site.
    """
    pages = docs.where(F.col(text).isNotNull()).select(
        F.col(host).alias("host"), digest16(F.col(text)).alias("page"), F.col(text).alias("text")
    )
    totals = pages.groupBy("host", "page").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("n_host_pages"))
    lines = (
        pages.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.trim(x)))).alias("line"))
        .where("line <> ''")
        .select("host", "page", digest16(F.col("line")).alias("line_key"))
    )
    counts = lines.distinct().groupBy("host", "line_key").agg(F.count("*").alias("n_pages"))
    same = counts["host"].eqNullSafe(totals["host"])
    return (
        counts.where(F.col("n_pages") >= min_pages)
        .join(totals, same)
        .where(F.col("n_pages") > ratio * F.col("n_host_pages"))
        .select(counts["host"], "line_key", "n_pages", "n_host_pages")
    )


def drop_site_lines(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    The digests of the lines to drop are gathered per distinct page of a site, bounded by the page itself, and joined
    back on that page, so no column of ``docs`` serves as a key.
    """
    flagged = boilerplate_lines(docs, text, host, ratio, min_pages).select(
        F.col("host").alias("_f_host"), F.col("line_key").alias("_f_key")
    )
    pages = docs.where(F.col(text).isNotNull()).select(
        F.col(host).alias("_host"), digest16(F.col(text)).alias("_page"), _lines(F.col(text)).alias("_all")
    )
    held = pages.select(
        "_host", "_page", F.explode(F.array_distinct(F.transform("_all", lambda x: F.trim(x)))).alias("_line")
    ).select("_host", "_page", digest16(F.col("_line")).alias("_key"))
    hit = held.join(flagged, F.col("_host").eqNullSafe(F.col("_f_host")) & (F.col("_key") == F.col("_f_key")))
    bad = hit.groupBy("_host", "_page").agg(F.collect_set("_key").alias("_bad"))
    keyed = docs.select(
        whole_row(docs).alias("row"), F.col(host).alias("host"), F.col(text).alias("text"), digest16(F.col(text)).alias("page")
    )
    joined = keyed.join(
        bad, keyed["host"].eqNullSafe(bad["_host"]) & (keyed["page"] == bad["_page"]), "left"
    ).select("row", "text", "_bad", _lines(F.col("text")).alias("lines"))
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("_bad"), digest16(F.trim(x))))
    marked = joined.select("row", "text", "lines", F.when(F.col("_bad").isNotNull(), kept).alias("kept"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    n_dropped = F.when(F.col("kept").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).cast("long")
    new = {
        text: F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text")),
        "n_lines": n_lines,
        "n_dropped": n_dropped,
    }
    return unpacked(marked, docs.columns, "row", new)
