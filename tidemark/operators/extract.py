"""Raw pages -> page records (main-content markdown, title, content hash).

Narrow: no shuffle.  The extraction chain is evaluated once per page; each
stage is its own projection so that Catalyst keeps the intermediate values
instead of inlining an expensive expression into several consumers.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions.text import normalize, sha256_hex
from .parallel import spread


def extract_pages(raw: DataFrame, html_col: str = "raw_html",
                  extractor: Callable[[str], str | None] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """``RAW_PAGE`` (+ any extra columns) -> ``PAGE`` (+ the same extra columns).

    markdown = main content (``<article>``/``<main>``, else body without
    furniture); when that is empty, the whole document.  content_hash is the
    prefixed SHA-256 of the normalized markdown.

    ``extractor`` (optional) replaces the built-in main-content step with a
    Python function ``html -> markdown or None`` (e.g. a third-party
    extractor), run per Arrow batch on the executors; its output is
    normalized, and the whole-document fallback still applies.

    ``partitions`` (optional) spreads the raw pages first, for inputs that
    arrive in fewer splits than the cluster has cores.
    """
    extra = [c for c in raw.columns if c not in ("url", html_col, "status", "fetched_at", "depth")]
    raw = spread(raw, "url", partitions=partitions)
    s1 = raw.select("*", H.strip_code(F.col(html_col)).alias("_code"))
    if extractor is None:
        s2 = s1.select("*", H.main_fragment_from_code("_code").alias("_frag"))
        # three projections: the entity step uses a higher-order function, which runs
        # interpreted; kept apart, the regex steps around it stay in generated code
        s2 = s2.select("*", H.tags_to_markdown("_frag").alias("_tags"))
        s2 = s2.select("*", H.decode_entities("_tags").alias("_text"))
        s3 = s2.select("*", H.finish_markdown("_text").alias("_md"))
    else:
        s3 = s1.select("*", normalize(F.coalesce(_python_extractor(extractor)(F.col(html_col)), F.lit("")))
                       .alias("_md"))
    # the fallback goes through the same stages, on the code-free page where the main content is empty
    s3 = s3.select("*", F.when(F.col("_md") == "", H.tags_to_markdown("_code", links=True)).alias("_whole"))
    s3 = s3.select("*", H.decode_entities("_whole").alias("_whole_text"))
    s4 = s3.select("*", F.when(F.col("_md") == "", H.finish_markdown("_whole_text")).otherwise(F.col("_md")).alias("markdown"))
    return s4.select(
        "url",
        H.page_title(F.col(html_col), F.col("markdown")).alias("title"),
        "markdown",
        sha256_hex(H.normalized_markdown("markdown")).alias("content_hash"),
        "fetched_at",
        F.col("status").cast("int").alias("status"),
        F.col("depth").cast("int").alias("depth"),
        *extra,
    )


def _python_extractor(fn: Callable[[str], str | None]):
    @F.pandas_udf(T.StringType())
    def run(html: pd.Series) -> pd.Series:
        return html.map(lambda h: None if h is None else fn(h))

    return run


def pages_ok(raw: DataFrame) -> DataFrame:
    """Only status-200 responses are extracted."""
    return raw.where(F.col("status") == 200)


def pages_nonblank(pages: DataFrame) -> DataFrame:
    """Drop pages whose markdown is blank (Unicode whitespace only)."""
    return pages.where(normalize("markdown") != "")


def pipeline_pages(raw: DataFrame, partitions: int | None = None) -> DataFrame:
    """status 200 -> extract -> non-blank: the page table a run keeps.

    A filter on ``markdown`` placed directly on the projection would be
    pushed below it with the extraction chain inlined, evaluating the chain
    twice per page.  Passing the page columns through a one-row ``inline``
    keeps the filter above the extraction, which then runs once.
    """
    pages = extract_pages(pages_ok(raw), partitions=partitions)
    return (pages.select(F.inline(F.array(F.struct(*pages.columns))))
                 .where(F.col("markdown") != ""))
