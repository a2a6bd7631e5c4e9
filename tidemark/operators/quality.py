"""Run and site figures: yield, low-yield flag, overall pass mark, counts.

All are partial/final hash aggregations: a site with a third of all pages
still sends one partial row per map task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Yield below this (with pages fetched) flags a site as likely
# rendered by JavaScript; an overall yield at or above PASS_RATE passes.
LOW_YIELD_RATE = 0.50
PASS_RATE = 0.90


def _rate(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def site_yield(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Per site: ``fetched`` (status-200 pages), ``nonempty`` (non-blank markdown), ``rate``, ``likely_js``.

    ``pages``: extracted pages with ``start_url, status, markdown``.  Every
    site of ``sites`` is reported, with zeros when it has no page.
    """
    ok = pages.where(F.col("status") == 200)
    agg = ok.groupBy("start_url").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("markdown") != "").alias("nonempty"),
    )
    j = sites.select("start_url").distinct().join(agg, "start_url", "left")
    fetched = F.coalesce(F.col("fetched"), F.lit(0)).cast("long")
    nonempty = F.coalesce(F.col("nonempty"), F.lit(0)).cast("long")
    rate = _rate(nonempty, fetched)
    return j.select(
        F.col("start_url").alias("site"), nonempty.alias("nonempty"), fetched.alias("fetched"),
        rate.alias("rate"), ((fetched > 0) & (rate < LOW_YIELD_RATE)).alias("likely_js"))


def overall_yield(site_rows: DataFrame) -> DataFrame:
    """One row: total non-empty / total fetched, and whether it reaches the pass mark."""
    agg = site_rows.agg(F.sum("nonempty").cast("long").alias("nonempty"),
                        F.sum("fetched").cast("long").alias("fetched"),
                        F.count_if(F.col("likely_js")).alias("likely_js_sites"))
    rate = _rate(F.coalesce(F.col("nonempty"), F.lit(0)), F.coalesce(F.col("fetched"), F.lit(0)))
    return agg.select("nonempty", "fetched", rate.alias("overall_rate"),
                      (rate >= PASS_RATE).alias("passed"), "likely_js_sites")


def site_counts(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pages and chunks per site."""
    p = pages.groupBy("start_url").agg(F.count(F.lit(1)).alias("pages"))
    c = chunks.groupBy("start_url").agg(F.count(F.lit(1)).alias("chunks"))
    return (p.join(c, "start_url", "full_outer")
             .select("start_url", F.coalesce("pages", F.lit(0)).cast("long").alias("pages"),
                     F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks")))
