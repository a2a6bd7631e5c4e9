"""Page markdown -> heading-aware chunks with stable ids and text hashes.

Plan shape (one Exchange, on the page key):

1. narrow, per page row: split the markdown into lines, find the ATX heading
   lines, and cut the line array into sections with array slices (linear in
   the page size); explode one row per section and normalize its body;
2. Exchange on ``(start_url, page_seq)``; one window pass gives each section
   the heading stack in force (for every level, the last heading of that
   level that no shallower heading has closed);
3. the same ordered pass counts the non-empty sections before each one (the
   0-based order); empty sections are then dropped (they still shaped the
   stack) and one more window over the same partitioning numbers repeated
   ids within a page.

A page is a single input row, so a hash partition on the page key cannot
concentrate more than one page in a task; the shuffle is skew-free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import heading_level, heading_text, normalize, sha256_hex, slug, token_estimate
from ..functions.urls import chunk_id_base

PAGE_KEY = ("start_url", "page_seq")
MAX_LEVEL = 6


def _sections(lines: Column, levels: Column, hpos: Column) -> Column:
    """array<struct<sec, level, heading, body>>: section 0 is the text before the first heading.

    ``lines``/``levels``/``hpos`` must be column references (computed in an
    earlier projection): the lambda runs once per section, and an inlined
    expression there would redo the line scan for every section.
    """
    m = F.size(hpos)
    n = F.size(lines)

    def section(s: Column) -> Column:
        start = F.when(s == 0, F.lit(0)).otherwise(F.get(hpos, s - 1) + 1)
        end = F.when(s == m, n).otherwise(F.get(hpos, s))
        head_line = F.get(lines, F.get(hpos, s - 1))
        return F.struct(
            s.alias("sec"),
            F.when(s == 0, F.lit(0)).otherwise(F.get(levels, F.get(hpos, s - 1))).alias("level"),
            F.when(s == 0, F.lit("")).otherwise(heading_text(head_line)).alias("heading"),
            F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("body"),
        )

    return F.transform(F.sequence(F.lit(0), m), section)


def markdown_sections(pages: DataFrame, key=PAGE_KEY) -> DataFrame:
    """One row per section: ``key..., url, sec, level, heading, text`` (text normalized)."""
    key = list(key)
    lines = pages.select(*key, "url", chunk_id_base("url").alias("_id_base"),
                         F.split("markdown", "\n", -1).alias("_lines"))
    levels = lines.select("*", F.transform("_lines", heading_level).alias("_levels"))
    # 0-based line numbers of the heading lines
    heads = levels.select("*", F.filter(
        F.transform("_levels", lambda lv, i: F.when(lv > 0, i).otherwise(-1)), lambda i: i >= 0).alias("_hpos"))
    return (
        heads.select(*key, "url", "_id_base",
                     F.inline(_sections(F.col("_lines"), F.col("_levels"), F.col("_hpos"))))
        .select(*key, "url", "_id_base", "sec", "level", "heading", normalize("body").alias("text"))
    )


def _breadcrumbs(sections: DataFrame, key) -> DataFrame:
    """Add ``heading_path`` (array<string>) = the heading stack at each section."""
    w = Window.partitionBy(*key).orderBy("sec").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [
        F.max(F.when(F.col("level") == k, F.struct(F.col("sec").alias("s"), F.col("heading").alias("h"))))
        .over(w)
        for k in range(1, MAX_LEVEL + 1)
    ]
    # 0-based position among non-empty sections, from the same ordered pass
    kept_before = F.sum(F.when(F.col("text") != "", 1).otherwise(0)).over(w) - 1
    out = sections.select("*", *[c.alias(f"_p{k + 1}") for k, c in enumerate(last)], kept_before.alias("_order"))
    entries = []
    for k in range(1, MAX_LEVEL + 1):
        pk = F.col(f"_p{k}")
        closed = F.lit(False)
        for j in range(1, k):
            pj = F.col(f"_p{j}")
            closed = closed | (pj.isNotNull() & (pj["s"] > pk["s"]))
        entries.append(F.when(pk.isNotNull() & ~closed, pk["h"]))
    path = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return out.select(*[c for c in sections.columns], path.alias("heading_path"), "_order")


def chunk_pages(pages: DataFrame, key=PAGE_KEY) -> DataFrame:
    """``pages(key..., url, markdown)`` -> chunks.

    Output: ``key..., chunk_id, url, heading_path, text, token_estimate,
    chunk_hash, order``.  Ids are ``netloc+path#dotted.slugs`` (``#root`` for
    text before the first heading); the n-th repeat of an id inside a page
    gets ``-n``; order is 0-based among non-empty sections.
    """
    key = list(key)
    sec = _breadcrumbs(markdown_sections(pages, key), key).where(F.col("text") != "")
    dotted = F.array_join(F.transform("heading_path", lambda h: slug(h)), ".")
    sec = sec.withColumn(
        "_base", F.concat("_id_base", F.lit("#"), F.when(F.size("heading_path") == 0, F.lit("root"))
                          .otherwise(dotted)))
    by_id = Window.partitionBy(*key, "_base").orderBy("sec")
    dup = F.row_number().over(by_id) - 1
    return sec.select(
        *key,
        F.when(dup == 0, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), dup.cast("string")))
        .alias("chunk_id"),
        "url",
        "heading_path",
        "text",
        token_estimate("text").alias("token_estimate"),
        sha256_hex("text").alias("chunk_hash"),
        F.col("_order").cast("int").alias("order"),
    )
