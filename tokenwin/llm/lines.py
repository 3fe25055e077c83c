"""Boilerplate lines by their frequency within a site, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.tables import fresh
from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

RATIO = 0.02
LEAST_PAGES = 5


def _lines(text: Column | str) -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """Hash of a line without the blanks around it; NULL for an empty one, which is never dropped."""
    bare = F.trim(line)
    return F.when(bare != "", F.xxhash64(bare))


def _site(site: str) -> Column:
    """The site as a text that tells NULL, a site of its own, from all names."""
    return F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit(""))


def boilerplate(pages: DataFrame, site: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(site, line)``: hashes of lines on more than ``ratio`` of the site's pages, and on ``least_pages`` at least.

    A line counts once a page. Counts are added up before the shuffle, so a site may have nearly all pages.
    A site has at most its mean number of lines a page / ``ratio`` such lines.
    """
    rows = pages.select(_site(site).alias("site"), _lines("text").alias("lines"))
    totals = rows.groupBy("site").agg(F.count("*").alias("pages"))
    hashes = F.array_distinct(F.transform("lines", _key))
    counts = rows.select("site", F.explode_outer(hashes).alias("line")).where("line is not null")
    counts = counts.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    often = counts.join(totals, "site").where(F.col("n") > F.col("pages") * ratio)
    return write_shared(often.select("site", "line"), "boilerplate")


def drop_boilerplate(
    pages: DataFrame, site: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """All rows and columns of ``pages``, ``text`` without boilerplate lines, and ``n_lines`` and ``n_dropped``.

    A NULL text stays NULL and has no line; a text whose lines all go becomes empty. Repeated rows each
    count as a page. Columns called ``n_lines`` or ``n_dropped`` are replaced; others may have any name.
    Pages do not move while the lines to drop fit a broadcast; beyond that, hot sites are split.
    """
    often = boilerplate(pages, site, ratio, least_pages)
    own, drop, lines, kept = (fresh(pages.columns, n) for n in ("site", "drop", "lines", "kept"))
    by_site = often.groupBy(F.col("site").alias(own)).agg(F.collect_list("line").alias(drop))
    split = F.when(F.col("text").isNotNull(), _lines("text"))
    rows = pages.withColumn(own, _site(site)).withColumn(lines, split)
    spread = [c for c in ("doc_id", "page_id", "text") if c in pages.columns]
    rows = lookup(rows, by_site, own, spread=spread, row_bytes=32, counted=often)
    left = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(drop), _key(x)), F.lit(False)))
    rows = rows.withColumn(kept, left)
    n_lines = F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines))
    n_kept = F.when(F.col(kept).isNull(), 0).otherwise(F.size(kept))
    added = {"text": F.array_join(kept, "\n"), "n_lines": n_lines, "n_dropped": n_lines - n_kept}
    others = [F.col(c) for c in pages.columns if c not in added]
    return rows.select(*others, *[v.alias(n) for n, v in added.items()])
