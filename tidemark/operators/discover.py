"""Which pages belong to a site: links, URL filters, robots, a breadth-first walk.

The walk runs for all sites at once, one level per iteration, on tables:
``responses(url, status)`` (what fetching a URL returned; a URL without a
row had no response), ``links(src_url, pos, dst_url)``, ``sites(start_url,
max_pages, include, exclude)``, optional robots rules and sitemap URLs.
Which URLs a site may fetch is settled once for all links; a level is then one
join of its pages with their links and one written table, and the driver only
asks whether any page is left.  State goes to the shared checkpoint folder each
level, so lineage stays short and a lost executor recomputes one level at most;
visited URLs are compacted every few levels.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import hrefs
from ..functions.urls import defrag, netloc, resolve, url_path, url_path_and_query
from ..session import ensure_checkpoint_dir, shuffles_dropped
from ..sources.discovery import _unquote
from ..sources.site_runs import _names

# --- links ----------------------------------------------------------------------

def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src_url, pos, href``: every ``<a href>`` of every page, in document order."""
    return pages.select(F.col(url_col).alias("src_url"), F.posexplode(hrefs(F.col(html_col))).alias("pos", "href"))


def links_resolved(links: DataFrame) -> DataFrame:
    """Adds ``dst_url`` = href resolved against the page URL, fragment dropped."""
    return links.withColumn("dst_url", defrag(resolve(F.col("src_url"), F.col("href"))))


def links_same_host(links: DataFrame) -> DataFrame:
    """Keeps links whose target has exactly the source's authority (scheme ignored)."""
    return links.where(netloc("dst_url") == netloc("src_url"))


def site_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src_url, pos, dst_url`` for a crawl: extracted, resolved, defragged, same host."""
    return links_same_host(links_resolved(page_links(pages, url_col, html_col))).select("src_url", "pos", "dst_url")


# --- URL filters ------------------------------------------------------------------

def glob_to_regex(glob: str) -> str:
    """``fnmatch`` glob -> anchored Java regex: ``*`` any run, ``?`` one character, ``[...]`` a class.

    Inside a class only a leading ``!`` and ranges are special; a ``[`` without
    its ``]`` is a plain character; an empty range matches nothing.
    """
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        i += 1
        if c in "*?":
            out.append(".*" if c == "*" else ".")
            continue
        end = glob.find("]", i + (2 if glob[i:i + 2] == "!]" else 1 if glob[i:i + 1] in ("!", "]") else 0)) if c == "[" else -1
        if end < 0:
            out.append(_plain(c))
            continue
        members, negated = glob[i:end], glob[i] == "!"
        members, i, k, parts = members[negated:], end + 1, 0, []
        while k < len(members):
            if k + 2 < len(members) and members[k + 1] == "-":
                if members[k] <= members[k + 2]:
                    parts.append(f"{_plain(members[k])}-{_plain(members[k + 2])}")
                k += 3
            else:
                parts.append(_plain(members[k]))
                k += 1
        out.append(f"[{'^' if negated else ''}{''.join(parts)}]" if parts else "." if negated else "(?!)")
    return "(?s)\\A" + "".join(out) + "\\z"


def _plain(c: str) -> str:
    """One character that stands for itself, in and outside classes."""
    return c if re.fullmatch(r"[A-Za-z0-9_/]", c) or ord(c) > 127 else f"\\x{{{ord(c):x}}}"


def site_globs(sites: DataFrame) -> DataFrame:
    """``sites`` with the globs of include and exclude as regexes: each site's globs are translated once."""
    @F.pandas_udf("array<string>")
    def regexes(globs: pd.Series) -> pd.Series:
        return globs.map(lambda g: None if g is None else [glob_to_regex(x) for x in g if x is not None])

    return sites.withColumns({c: regexes(c) for c in ("include", "exclude")})


def glob_ok(path: Column, include: Column, exclude: Column) -> Column:
    """Exclude regexes win; then some include regex must match (no include list = all)."""
    ex = F.coalesce(F.exists(exclude, lambda g: F.regexp_like(path, g)), F.lit(False))
    inc = F.when(F.coalesce(F.size(include), F.lit(0)) <= 0, F.lit(True)).otherwise(
        F.exists(include, lambda g: F.regexp_like(path, g)))
    return ~ex & inc


def pages_glob_filtered(urls: DataFrame, sites: DataFrame) -> DataFrame:
    """``urls(start_url, url)`` + ``allowed``: start URL exempt, others by the site's globs on ``path or '/'``."""
    j = urls.join(site_globs(sites.select("start_url", "include", "exclude")), "start_url", "left")
    path = url_path("url")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    allowed = (F.col("url") == defrag("start_url")) | glob_ok(path, F.col("include"), F.col("exclude"))
    return j.select(*urls.columns, allowed.alias("allowed"))


def robots_allowed(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``robots_ok``: the first matching rule of the URL's host decides; no match allows.

    A rule matches the URLs that begin with its path.  Each distinct ``(host,
    path+query)`` is expanded to its beginnings of those lengths that the
    host's rules have, and meets the rules by an equi-join on (host, beginning),
    so a URL is never compared with all rules of its host.  Of the matches the
    first rule is picked by an aggregate and joined back.
    """
    u = urls.select("*", netloc(url_col).alias("_host"), _unquote(url_path_and_query(url_col)).alias("_pq"))
    r = rules.select(F.col("host").alias("_host"), F.col("seq").alias("_seq"), F.col("allow").alias("_allow"),
                     F.col("path").alias("_begin"))
    lengths = r.select("_host", F.length("_begin").alias("_n")).distinct().groupBy("_host").agg(F.collect_set("_n").alias("_lengths"))
    keys = u.select("_host", "_pq").distinct().join(lengths, "_host")
    begins = keys.select("_host", "_pq", F.explode("_lengths").alias("_n")).where(F.length("_pq") >= F.col("_n")) \
        .select("_host", "_pq", F.substring("_pq", F.lit(1), F.col("_n")).alias("_begin"))
    verdict = begins.join(r, ["_host", "_begin"]).groupBy("_host", "_pq").agg(F.min_by("_allow", "_seq").alias("_v"))
    return (u.join(verdict, ["_host", "_pq"], "left")
             .select(*urls.columns, F.coalesce("_v", F.lit(True)).alias("robots_ok")))


# --- fetch log --------------------------------------------------------------------

def fetch_log_resolved(log: DataFrame, max_attempts: int = 3) -> DataFrame:
    """``log(url, attempt, status or null = timeout)`` -> the response kept per URL.

    The first attempt answered below 500 wins; a 5xx on the last attempt is
    kept; a URL whose last attempt timed out has no response (no row).
    """
    usable = log.where((F.col("status") < 500) | ((F.col("attempt") == max_attempts) & (F.col("status") >= 500)))
    return usable.groupBy("url").agg(F.min_by("status", "attempt").alias("status"),
                                     F.min("attempt").alias("attempt"))


# --- breadth-first walk -------------------------------------------------------------

def links_first_seen(frontier_pages: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame:
    """One expansion step: new URLs reached from ``frontier_pages(start_url, url, seq, depth)``.

    Each new URL keeps its first discovery in ``(seq, pos)`` order, which
    becomes its rank in the next level.  The per-URL pick is an aggregate
    (map-side combined), not a window, so a URL linked from a third of all
    pages is still reduced before the shuffle.
    """
    out = (frontier_pages.select("start_url", F.col("url").alias("src_url"), "seq", "depth")
           .join(links, "src_url")
           .where(netloc("dst_url") == netloc("start_url"))
           .select("start_url", F.col("dst_url").alias("url"), "depth",
                   F.struct("seq", "pos").alias("rank")))
    first = out.groupBy("start_url", "url").agg(F.min(F.struct("rank", "depth")).alias("_f"))
    first = first.select("start_url", "url", (F.col("_f.depth") + 1).alias("depth"), F.col("_f.rank").alias("rank"))
    return first.join(seen, ["start_url", "url"], "left_anti")


class _LevelStore:
    """Per-level state written as parquet tables in the shared checkpoint folder.

    Writing a table computes a level once and cuts its lineage (a checkpoint
    would compute it twice); a lost executor costs at most the current level.
    """

    def __init__(self, spark):
        import uuid

        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bfs-{uuid.uuid4().hex}"
        self.n = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{name}-{self.n}"
        with shuffles_dropped(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_all(self) -> None:
        """Delete the levels; nothing may read them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Levels after which the tables of visited URLs are written as one, and order keys become numbers again.
COMPACT_EVERY = 8
#: Links of a folder of the walk's link table: a level opens the folders its pages fall into.
LINKS_PER_FOLDER = 1_000_000
MOST_FOLDERS = 1024


class _Edges:
    """The links a walk may follow, in folders by a hash of (site, page): a level reads only those of its frontier."""

    def __init__(self, edges: DataFrame, store: _LevelStore):
        self.store = store
        whole = store.put(edges, "edges")
        self.folders = min(MOST_FOLDERS, 1 + whole.count() // LINKS_PER_FOLDER)
        self.schema, self.path = whole.schema, None
        if self.folders == 1:
            self.whole = whole
            return
        store.n += 1
        self.path = f"{store.root}/edges-{store.n}"
        whole.withColumn("folder", self._folder("src_url")).repartition("folder").sortWithinPartitions("folder", "start_url", "src_url") \
            .write.partitionBy("folder").parquet(self.path)

    def _folder(self, url: str):
        return F.pmod(F.xxhash64("start_url", url), F.lit(self.folders)).cast("int")

    def of(self, pages: DataFrame) -> DataFrame:
        """The links of the folders that ``pages(start_url, url)`` fall into (at most MOST_FOLDERS numbers reach the driver)."""
        if self.path is None:
            return self.whole
        touched = sorted(r[0] for r in pages.select(self._folder("url")).distinct().collect())
        have = set(_names(self.store.spark, self.path))
        paths = [f"{self.path}/folder={n}" for n in touched if f"folder={n}" in have]
        return self.store.spark.read.schema(self.schema).parquet(*paths) if paths else self.store.spark.createDataFrame([], self.schema)


def site_bfs(responses: DataFrame, links: DataFrame, sites: DataFrame, robots_rules: DataFrame | None = None,
             sitemap: DataFrame | None = None) -> DataFrame:
    """Pages a crawl of every site fetches: ``start_url, url, depth, seq, status``.

    Semantics of a FIFO crawl per site: start URL at depth 0; children at
    parent depth + 1 in (parent order, link position) order; each URL once;
    globs (start URL exempt) and robots filter a URL when its turn comes;
    a URL with no response is skipped; every response (any status) counts
    toward ``max_pages`` (null: no limit) and only status-200 pages are
    expanded.  When a site's link walk drains, its sitemap URLs (same host,
    allowed by the globs, not yet seen) are walked next from depth 0.
    ``seq`` is the 1-based fetch order within the site.  ``sites`` may carry a
    boolean ``respect_robots`` (default true) to walk a site without its
    robots rules.

    Whether a site may fetch a URL depends on neither its turn nor the page
    that links to it, so that is settled once: the walk runs over the links to
    fetchable pages.  Sites walk in lock step, one level and one written table
    per iteration; a page's place in its level is its order key (parent's key,
    link position), and pages are numbered at the end.  The sitemap phase of
    all sites starts when every link walk has drained (a site's result does not
    depend on when its phase starts).
    """
    spark = responses.sparkSession
    store = _LevelStore(spark)
    respect = F.col("respect_robots") if "respect_robots" in sites.columns else F.lit(True)
    sites = store.put(site_globs(sites.select(
        "start_url", F.col("max_pages").cast("long").alias("max_pages"), "include", "exclude",
        F.coalesce(respect, F.lit(True)).alias("respect_robots"))), "sites")
    responses = responses.select("url", F.col("status").cast("int").alias("status"))
    hosts = sites.select("start_url", netloc("start_url").alias("host"))
    edges = (links.select("src_url", F.col("pos").cast("int").alias("pos"), "dst_url").withColumn("host", netloc("dst_url")).join(hosts, "host").drop("host"))
    roots = sites.select("start_url", defrag("start_url").alias("url"))
    targets = edges.select("start_url", F.col("dst_url").alias("url")).union(roots)
    sm = None
    if sitemap is not None:
        sm = (sitemap.select("host", "part", "pos", defrag("url").alias("url")).join(hosts, "host").where(netloc("url") == F.col("host"))
                     .groupBy("start_url", "url").agg(F.min(F.struct(F.col("part").cast("int").alias("part"), F.col("pos").cast("int").alias("pos"))).alias("_o"))
                     .select("start_url", "url", F.array("_o.part", "_o.pos").alias("key")))
        targets = targets.union(sm.select("start_url", "url"))
    pages = store.put(_fetchable(targets.distinct(), responses, sites, robots_rules), "pages")
    edges = _Edges(edges.join(pages.select("start_url", F.col("url").alias("dst_url"), F.col("status").alias("edge_status")), ["start_url", "dst_url"]), store)
    if sm is not None:
        sm = store.put(sm.join(pages, ["start_url", "url"]), "sitemap")
    capped = not sites.where(F.col("max_pages").isNotNull()).isEmpty()
    found: list[DataFrame] = []
    full = None      # sites that reached their cap

    def one(parts: list[DataFrame]) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, parts)

    def without_full(df: DataFrame) -> DataFrame:
        return df if full is None else df.join(full, "start_url", "left_anti")

    def admitted(rows: DataFrame, phase: int) -> DataFrame:
        """The level, cut where a site's cap falls into it."""
        nonlocal full
        level = store.put(rows.select("start_url", "url", F.lit(phase).alias("phase"), F.col("depth").cast("int").alias("depth"), "key", "status"), "level")
        if not capped:
            return level
        here = level.groupBy("start_url").agg(F.count(F.lit(1)).alias("m"))
        before = one([*found, level.limit(0)]).groupBy("start_url").agg(F.count(F.lit(1)).alias("n"))
        room = F.col("max_pages") - F.coalesce("n", F.lit(0))
        over = store.put(here.join(sites.select("start_url", "max_pages"), "start_url").join(before, "start_url", "left")
                         .where(F.col("m") >= room).select("start_url", room.alias("room")), "over")
        if over.isEmpty():
            return level
        full = over.select("start_url") if full is None else full.union(over.select("start_url"))
        cut = number_within(level.join(over, "start_url"), "start_url", "key", store).where(F.col("_rn") <= F.col("room"))
        return store.put(level.join(over, "start_url", "left_anti").union(cut.select(*level.columns)), "level")

    level, phase = admitted(roots.join(pages, ["start_url", "url"]).select("*", F.lit(0).alias("depth"), F.array(F.lit(0)).alias("key")), 0), 0
    while True:
        if level.isEmpty():
            if sm is None:
                break
            # every site's link walk has drained: sites under their cap go on with the sitemap
            orphans, sm, phase = without_full(sm).join(one([*found, level]), ["start_url", "url"], "left_anti"), None, 1
            level = admitted(orphans.withColumn("depth", F.lit(0)), phase)
            continue
        found.append(level)
        if len(found) % COMPACT_EVERY == 0:
            found = [store.put(one(found), "found")]
            numbered = number_within(level, "start_url", "key", store)
            level = store.put(numbered.select("start_url", "url", "depth", F.array(F.col("_rn").cast("int")).alias("key"), "status"), "numbered")
        frontier = without_full(level.where("status = 200")).select("start_url", F.col("url").alias("src_url"), "depth", "key")
        reached = frontier.join(edges.of(frontier.withColumnRenamed("src_url", "url")), ["start_url", "src_url"])
        # a page that a third of all pages link to is reduced before the shuffle
        first = reached.groupBy("start_url", F.col("dst_url").alias("url")).agg(
            F.min(F.struct("key", "pos", "depth")).alias("f"), F.first(F.col("edge_status")).alias("status"))
        first = first.select("start_url", "url", (F.col("f.depth") + 1).alias("depth"), F.concat("f.key", F.array("f.pos")).alias("key"), "status")
        level = admitted(first.join(one(found), ["start_url", "url"], "left_anti"), phase)
    order = F.struct("phase", "depth", "key")
    every = number_within(one([*found, level]).withColumn("_order", order), "start_url", "_order", store)
    result = _LevelStore(spark).put(every.select("start_url", "url", "depth", F.col("_rn").cast("long").alias("seq"), "status"), "result")
    store.drop_all()
    return result


def _fetchable(targets: DataFrame, responses: DataFrame, sites: DataFrame, robots_rules: DataFrame | None) -> DataFrame:
    """``start_url, url, status`` of the URLs that a site's globs and robots rules allow and that have a response."""
    f = targets.join(sites.drop("max_pages"), "start_url")
    path = url_path("url")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    f = f.where((F.col("url") == defrag("start_url")) | glob_ok(path, F.col("include"), F.col("exclude")))
    if robots_rules is not None:
        f = robots_allowed(f.select("start_url", "url", "respect_robots"), robots_rules.select("host", "seq", "allow", "path")) \
            .where(F.col("robots_ok") | ~F.col("respect_robots"))
    return f.select("start_url", "url").join(responses, "url").select("start_url", "url", "status")


def number_within(df: DataFrame, group: str, order: str | tuple[str, ...], store: _LevelStore) -> DataFrame:
    """``_rn``: 1-based position within ``group`` by ``order``, with no group in one task.

    The rows are range-partitioned on ``(group, order)``, sorted, and stored with
    a number that counts up within their partition; a site then spans consecutive
    partitions.  Rows per (site, partition) are counted, and the small count table
    gives what to add to the numbers of each, so the rows are shuffled once.
    """
    by = (group, *((order,) if isinstance(order, str) else order))
    ranged = store.put(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_pid", F.shiftright("_at", 33))  # the partition, of whose numbers the lower 33 bits count
    counts = ranged.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_at").alias("_least"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_pid", (F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_least") + 1).alias("_off"))
    return (ranged.join(offsets, [group, "_pid"])
                  .withColumn("_rn", F.col("_off") + F.col("_at"))
                  .drop("_pid", "_off", "_at"))
