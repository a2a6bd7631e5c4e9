"""Site text outputs: link index, full text, JSON lines.

A site's index or full text can be larger than one string may hold, so both
are produced as record tables with sort keys; the text sink orders them
(range-partitioned sort) and writes them in sequence.  No per-site array is
collected and no per-site window numbers the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..functions.urls import netloc

# The header of a site's link index, one entry per line.
# {host} and {start_url} are filled per site.
INDEX_HEADER = (
    "# {host}",
    "",
    "> LLM-ready index of documentation crawled from {start_url}.",
    "",
    "## Pages",
)
# Fixed value: separator between page blocks of the full text.
FULL_SEPARATOR = "\n---\n\n"

RECORD_ORDER = ["start_url", "part", "sort_url", "sort_seq"]


def site_host(start_url="start_url"):
    """Host of the start URL, the URL itself when it has none."""
    c = F.col(start_url) if isinstance(start_url, str) else start_url
    return F.coalesce(F.nullif(netloc(c), F.lit("")), c)


def _display_title():
    return F.coalesce(F.nullif(strip_ws("title"), F.lit("")), F.col("url"))


def llms_index(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Link-index lines: ``start_url, part, sort_url, sort_seq, line``.

    part 0 is the header (``sort_seq`` = line number), part 1 one
    ``- [title](url)`` line per page ordered by url then crawl order.  Every
    site in ``sites`` gets its header even without pages.
    """
    header_lines = []
    for i, tmpl in enumerate(INDEX_HEADER):
        parts = tmpl.replace("{host}", "\x00h\x00").replace("{start_url}", "\x00s\x00").split("\x00")
        cols = [site_host() if p == "h" else F.col("start_url") if p == "s" else F.lit(p) for p in parts if p != ""]
        line = F.concat(*cols) if cols else F.lit("")
        header_lines.append(F.struct(F.lit(i).cast("long").alias("sort_seq"), line.alias("line")))
    header = (sites.select("start_url").distinct()
                   .select("start_url", F.inline(F.array(*header_lines)))
                   .select("start_url", F.lit(0).alias("part"), F.lit("").alias("sort_url"), "sort_seq", "line"))
    links = pages.select(
        "start_url", F.lit(1).alias("part"), F.col("url").alias("sort_url"),
        F.col("page_seq").cast("long").alias("sort_seq"),
        F.concat(F.lit("- ["), _display_title(), F.lit("]("), F.col("url"), F.lit(")")).alias("line"))
    return header.unionByName(links)


def llms_full(pages: DataFrame) -> DataFrame:
    """Full-text records: ``start_url, part, sort_url, sort_seq, record``.

    Writing a site's records in order, each followed by a newline, gives
    the blocks ``# title\\n<url>\\n\\nmarkdown\\n`` joined by ``\\n---\\n\\n``
    plus a final newline.  The last page of a site is found with a per-site max (partial
    aggregation) joined back on the page's own key, so no key is hot.
    """
    block = F.concat(F.lit("# "), _display_title(), F.lit("\n<"), F.col("url"), F.lit(">\n\n"),
                     strip_ws("markdown"), F.lit("\n"))
    pos = F.struct(F.col("url").alias("u"), F.col("page_seq").alias("s"))
    last = (pages.groupBy("start_url").agg(F.max(pos).alias("_last"))
                 .select("start_url", F.col("_last.u").alias("url"), F.col("_last.s").alias("page_seq"),
                         F.lit(True).alias("_is_last")))
    j = pages.join(last, ["start_url", "url", "page_seq"], "left")
    return j.select(
        "start_url", F.lit(1).alias("part"), F.col("url").alias("sort_url"),
        F.col("page_seq").cast("long").alias("sort_seq"),
        F.concat(block, F.when(F.col("_is_last"), F.lit("")).otherwise(F.lit(FULL_SEPARATOR[:-1]))).alias("record"))


def jsonl(df: DataFrame) -> DataFrame:
    """One JSON object per row (the JSON-lines form of a table)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
