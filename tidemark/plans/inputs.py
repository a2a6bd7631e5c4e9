"""Inputs derived from the driver's tables with column arithmetic only.

The same derivations are stated in SQL in :mod:`tidemark.plans.oracle`, so
DuckDB sees exactly the inputs Spark sees.  They simulate what the library
consumes in production: fetched pages of many sites, two crawls of the same
sites a week apart, multi-heading documents and large chunk snapshots.
Queries over two crawls leave out what the later or earlier crawl did not
see; all other queries take every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import defrag, netloc, site_start_url
from ..sources.tables import table

# Fixed values of the simulated runs.
PREV_RUN_AT = "2026-01-01T00:00:00+00:00"
CUR_RUN_AT = "2026-01-08T00:00:00+00:00"
SYSTEM_PROMPT = "You write one changelog line for a changed passage. Reply with a JSON object: summary (text) and tags (list of words)."


def _status(page_id, failing_5xx: int):
    return (F.when(page_id % 17 == 0, F.lit(404))
            .when(page_id % failing_5xx == 0, F.lit(500))
            .otherwise(F.lit(200)))


def raw_pages(spark: SparkSession, sf_dir: str, version: str = "cur") -> DataFrame:
    """Fetched pages of one crawl.

    ``prev``: the crawl a week earlier (pages with ``page_id % 10 = 0`` not
    yet published; 5xx on ``page_id % 23 = 0``).  ``cur``: this week's crawl
    (pages with ``page_id % 10 = 1`` taken down; 5xx on ``page_id % 29 = 0``;
    a sentence added to every 7th article; the markup of every 11th page
    re-indented, which must not count as an edit).  ``all``: this week's
    crawl without the take-downs, every row of ``pages``, for the queries
    that look at one crawl only.
    """
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    if version == "prev":
        p = p.where(pid % 10 != 0)
        html = F.col("html")
        status, fetched = _status(pid, 23), PREV_RUN_AT
    else:
        if version == "cur":
            p = p.where(pid % 10 != 1)
        html = F.when(pid % 7 == 0, F.replace(
            F.col("html"), F.lit("</article>"),
            F.concat(F.lit("<p>Revised note for page "), pid.cast("string"), F.lit(".</p></article>")),
        )).otherwise(F.col("html"))
        html = F.when(pid % 11 == 0, F.replace(html, F.lit("</p><p>"), F.lit("</p>\n   \n<p>"))).otherwise(html)
        status, fetched = _status(pid, 29), CUR_RUN_AT
    return p.select(
        site_start_url("url").alias("start_url"),
        pid.alias("page_seq"),
        F.col("url"),
        html.alias("raw_html"),
        status.cast("int").alias("status"),
        F.lit(fetched).alias("fetched_at"),
        (pid % 4).cast("int").alias("depth"),
    )


def crawled_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``start_url`` of every site that one of the two crawls, or ledgers, saw; each table is read once."""
    pid = F.col("page_id")
    web = table(spark, sf_dir, "pages").where((pid % 10 != 0) | (pid % 10 != 1)).select(site_start_url("url").alias("start_url"))
    lines = table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) | (F.col("l_discount") < 0.1))
    return web.union(lines.select(F.concat(F.lit("https://"), F.lower("l_returnflag"), F.lit(".ledger.example.com/")))).distinct()


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One markdown page per conversation: ``# Conversation n`` then ``## role`` per turn.

    Repeated ``## user`` / ``## assistant`` headings exercise the ``-1``,
    ``-2`` id suffixes.  Turns are ordered by an explicit sort key.
    """
    c = table(spark, sf_dir, "conversations")
    block = F.concat(F.lit("## "), F.col("role"), F.lit("\n\n"), F.col("text"))
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))).alias("t"))
    return turns.select(
        F.lit("https://chat.example.com/").alias("start_url"),
        F.col("conv_id").alias("page_seq"),
        F.concat(F.lit("https://chat.example.com/c/"), F.col("conv_id").cast("string")).alias("url"),
        F.concat(F.lit("# Conversation "), F.col("conv_id").cast("string"), F.lit("\n\n"),
                 F.array_join(F.transform("t", lambda x: x["b"]), "\n\n")).alias("markdown"),
    )


def account_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer: a root line, ``#`` region, ``##`` nation, ``####`` segment.

    The skipped level 3 and the empty region/nation sections exercise the
    heading stack.  ``nation`` and ``region`` are fixed 25- and 5-row
    dimensions, so broadcasting them is bounded at any scale.
    """
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    re_ = table(spark, sf_dir, "region")
    j = (cu.join(F.broadcast(na), cu.c_nationkey == na.n_nationkey)
           .join(F.broadcast(re_), na.n_regionkey == re_.r_regionkey))
    cents = F.round(F.col("c_acctbal") * 100).cast("long").cast("string")
    md = F.concat(
        F.lit("Account "), F.col("c_custkey").cast("string"),
        F.lit("\n\n# "), F.col("r_name"),
        F.lit("\n\n## "), F.col("n_name"),
        F.lit("\n\n#### "), F.col("c_mktsegment"),
        F.lit("\n\n"), F.col("c_name"), F.lit(" balance "), cents, F.lit(" cents"),
    )
    return j.select(
        F.lit("https://accounts.example.com/").alias("start_url"),
        F.col("c_custkey").alias("page_seq"),
        F.concat(F.lit("https://accounts.example.com/"), F.lower("r_name"), F.lit("/"),
                 F.col("c_custkey").cast("string")).alias("url"),
        md.alias("markdown"),
    )


def ledger_chunks(spark: SparkSession, sf_dir: str, version: str = "cur") -> DataFrame:
    """Large chunk snapshots built from ``lineitem`` (one chunk per order line, one
    ledger site per return flag).

    ``prev``: lines shipped before 1998, all still open.  ``cur``: lines with
    a discount under 10 %, with their real line status.  So the diff has
    added, removed, modified and unchanged rows at 600 k lines (sf0.1).
    ``all``: every line with its real status.
    """
    from ..operators.parallel import session_partitions, spread

    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", partitions=session_partitions(spark))
    if version == "prev":
        li = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        status = F.lit("O")
    else:
        if version == "cur":
            li = li.where(F.col("l_discount") < 0.1)
        status = F.col("l_linestatus")
    ok = F.col("l_orderkey").cast("string")
    ln = F.col("l_linenumber").cast("string")
    text = F.concat(
        F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" from supplier "),
        F.col("l_suppkey").cast("string"), F.lit(": "),
        F.round(F.col("l_quantity") * 100).cast("long").cast("string"), F.lit(" hundredths, status "),
        status, F.lit("."),
    )
    host = F.concat(F.lower("l_returnflag"), F.lit(".ledger.example.com"))
    return li.select(
        F.concat(F.lit("https://"), host, F.lit("/")).alias("start_url"),
        F.col("l_orderkey").alias("page_seq"),
        F.concat(host, F.lit("/orders/"), ok, F.lit("#line-"), ln).alias("chunk_id"),
        F.concat(F.lit("https://"), host, F.lit("/orders/"), ok).alias("url"),
        F.array(F.concat(F.lit("Order "), ok), F.concat(F.lit("Line "), ln)).alias("heading_path"),
        text.alias("text"),
        F.size(F.split(text, " ")).cast("int").alias("token_estimate"),
        F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("chunk_hash"),
        (F.col("l_linenumber") - 1).cast("int").alias("order"),
    )


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, host, start_url`` of every test page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", netloc("url").alias("host"), site_start_url("url").alias("start_url"),
                    defrag("url").alias("clean_url"))


# --- a crawlable web: responses, links, sitemaps, robots, site settings --------------------

CRAWL_AGENT = "tidemark"


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test pages as crawl targets: ``page_id, url`` (fragment dropped), ``host, start_url, status, html``."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", defrag("url").alias("url"), netloc("url").alias("host"),
                    site_start_url("url").alias("start_url"),
                    F.when(F.col("page_id") % 17 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
                    "html")


def crawl_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, status``: one response per URL (the lowest page id when two rows share a URL),
    plus a status-200 home page per site."""
    p = crawl_pages(spark, sf_dir)
    pages = p.groupBy("url").agg(F.min_by("status", "page_id").alias("status"))
    homes = p.select(F.col("start_url").alias("url")).distinct().select("url", F.lit(200).alias("status"))
    return pages.unionByName(homes)


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src_url, pos, dst_url``: the nav links found in each page's HTML (after position 0..),
    plus a link tree: page ``q`` is linked from the same-host page ``q div 2`` at position
    ``1000 + q``, else from its site's home unless ``q % 3 = 0`` (then only the sitemap lists it)."""
    from ..operators.discover import site_links

    p = crawl_pages(spark, sf_dir)
    nav = site_links(p.where(F.col("status") == 200).select("url", "html"))
    q = p.select("page_id", "url", "host", "start_url")
    par = p.select(F.col("page_id").alias("p_id"), F.col("url").alias("p_url"), F.col("host").alias("p_host"))
    j = q.join(par, (q.host == par.p_host) & (F.floor(q.page_id / 2) == par.p_id), "left")
    src = F.when(F.col("p_url").isNotNull(), F.col("p_url")).when(F.col("page_id") % 3 != 0, F.col("start_url"))
    tree = j.select(src.alias("src_url"), (F.col("page_id") + 1000).cast("int").alias("pos"),
                    F.col("url").alias("dst_url")).where(F.col("src_url").isNotNull())
    return nav.unionByName(tree)


def crawl_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host, part, xml``: one sitemap document per page with ``page_id % 3 = 0``."""
    p = crawl_pages(spark, sf_dir).where(F.col("page_id") % 3 == 0)
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/'
                         'sitemap/0.9"><url><loc>'), F.replace("url", F.lit("&"), F.lit("&amp;")),
                   F.lit("</loc></url></urlset>"))
    return p.select("host", F.col("page_id").alias("part"), xml.alias("xml"))


def crawl_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host, text``: ``m.`` hosts keep our agent out of ``/fr/`` and others out of ``/de/``;
    ``www.`` hosts keep everyone out of ``/es/``; other hosts have no robots file."""
    h = crawl_pages(spark, sf_dir).select("host").distinct()
    m = "User-agent: *\nDisallow: /de/\n\nUser-agent: " + CRAWL_AGENT + "\nDisallow: /fr/\nAllow: /\n"
    www = "# shared rules\nUser-agent: *\nDisallow: /es/\nDisallow:\n"
    text = F.when(F.col("host").startswith("m."), F.lit(m)).when(F.col("host").startswith("www."), F.lit(www))
    return h.select("host", text.alias("text")).where(F.col("text").isNotNull())


def crawl_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``start_url, max_pages, include, exclude``: a cap of 5 for ``blog.`` hosts (100 otherwise);
    ``www.`` hosts exclude ``*.html`` paths."""
    h = crawl_pages(spark, sf_dir).select("host", "start_url").distinct()
    return h.select(
        "start_url",
        F.when(F.col("host").startswith("blog."), F.lit(5)).otherwise(F.lit(100)).alias("max_pages"),
        F.lit(None).cast("array<string>").alias("include"),
        F.when(F.col("host").startswith("www."), F.array(F.lit("*.html"))).otherwise(
            F.lit(None).cast("array<string>")).alias("exclude"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, attempt, status``: three consecutive events are the three tries of one URL;
    errors answer 503, views 200, clicks 302, purchases 404, sign-ups time out."""
    ev = table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "view", 200)
              .when(F.col("event_type") == "click", 302).when(F.col("event_type") == "purchase", 404))
    return ev.select(
        F.concat(F.lit("https://shop.example.com/e/"), F.floor(F.col("event_id") / 3).cast("string")).alias("url"),
        (F.col("event_id") % 3 + 1).cast("int").alias("attempt"), status.cast("int").alias("status"))
