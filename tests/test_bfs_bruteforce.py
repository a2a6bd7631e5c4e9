"""The level-synchronous Spark walk against places computed from link paths on the same tables."""

from fnmatch import fnmatchcase
from urllib.parse import urldefrag, urlsplit

import pytest
from conftest import SF_MID, SF_SMALL

from tidemark.operators import discover as X
from tidemark.plans import inputs as I
from tidemark.sources import discovery as SD


class Web:
    """The crawl tables in memory."""

    def __init__(self, spark, sf):
        self.responses = {r.url: r.status for r in I.crawl_responses(spark, sf).collect()}
        self.links = {}
        for r in I.crawl_links(spark, sf).collect():
            self.links.setdefault(r.src_url, []).append((r.pos, r.dst_url))
        self.sites = I.crawl_sites(spark, sf).collect()
        self.sitemap = {}
        for r in SD.sitemap_urls(I.crawl_sitemaps(spark, sf)).collect():
            self.sitemap.setdefault(r.host, []).append(((r.part, r.pos), urldefrag(r.url)[0]))

    def robots(self, url):
        """The rules of inputs.crawl_robots, said in words."""
        u = urlsplit(url)
        if u.netloc.startswith("m."):
            return not u.path.startswith("/fr/")
        return not (u.netloc.startswith("www.") and u.path.startswith("/es/"))

    def fetchable(self, site, url):
        u = urlsplit(url)
        if u.netloc != urlsplit(site.start_url).netloc or url not in self.responses or not self.robots(url):
            return False
        if url == urldefrag(site.start_url)[0]:
            return True
        path = u.path or "/"
        return not any(fnmatchcase(path, g) for g in site.exclude or []) and \
            (not site.include or any(fnmatchcase(path, g) for g in site.include))

    def places(self, site, roots, known):
        """url -> (depth, positions of the links that lead there): the least of all paths, found by relaxation."""
        best = {u: (0, (p,)) for p, u in roots}
        todo = set(best)
        while todo:
            u = todo.pop()
            if self.responses[u] != 200:
                continue
            depth, path = best[u]
            for pos, dst in self.links.get(u, []):
                place = (depth + 1, (*path, pos))
                if dst not in known and self.fetchable(site, dst) and (dst not in best or place < best[dst]):
                    best[dst] = place
                    todo.add(dst)
        return best

    def walk(self, site, with_sitemap):
        start = urldefrag(site.start_url)[0]
        linked = self.places(site, [(0, start)] if self.fetchable(site, start) else [], {})
        order = sorted(linked.items(), key=lambda x: x[1])
        if with_sitemap:
            listed = {}
            for place, u in self.sitemap.get(urlsplit(site.start_url).netloc, []):
                if u not in linked and self.fetchable(site, u):
                    listed[u] = min(place, listed.get(u, place))
            order += sorted(self.places(site, [(p, u) for u, p in listed.items()], linked).items(), key=lambda x: x[1])
        return [(site.start_url, u, depth, n, self.responses[u]) for n, (u, (depth, _)) in enumerate(order, 1)]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_walk_matches_link_paths(spark, sf):
    web = Web(spark, sf)
    rules = SD.robots_rules(I.crawl_robots(spark, sf), I.CRAWL_AGENT)
    got = X.site_bfs(I.crawl_responses(spark, sf), I.crawl_links(spark, sf), I.crawl_sites(spark, sf), rules,
                     SD.sitemap_urls(I.crawl_sitemaps(spark, sf))).collect()
    expected = [row for s in web.sites for row in web.walk(s, True)[:s.max_pages]]
    assert sorted((r.start_url, r.url, r.depth, r.seq, r.status) for r in got) == sorted(expected)
    assert len(expected) > 0


def test_no_limit_drops_pages(spark):
    """A chain longer than the compaction interval, more pages than any default, and no cap."""
    home, n = "https://long.example.org/", 151
    urls = [home] + [f"{home}p{i}" for i in range(1, n)]
    chain = [(urls[i], 0, urls[i + 1]) for i in range(12)]
    fan = [(urls[12], i, urls[i]) for i in range(13, n)]
    responses = spark.createDataFrame([(u, 200) for u in urls], "url string, status int")
    links = spark.createDataFrame(chain + fan, "src_url string, pos int, dst_url string")
    sites = spark.createDataFrame([(home, None, None, None)], "start_url string, max_pages int, include array<string>, exclude array<string>")
    got = X.site_bfs(responses, links, sites).collect()
    assert len(got) == n and max(r.depth for r in got) == 13
    assert [r.url for r in sorted(got, key=lambda r: r.seq)] == urls


def test_numbering_without_a_hot_task(spark):
    """Range-based numbering equals row_number over the whole group."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.operators.discover import _LevelStore, number_within

    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
        .alias("site"), F.struct((F.col("id") * 7919 % 20011).alias("a"), F.col("id").alias("b")).alias("rank"))
    got = number_within(df.repartition(16), "site", "rank", _LevelStore(spark))
    want = df.withColumn("_rn", F.row_number().over(Window.partitionBy("site").orderBy("rank")))
    assert got.select("site", "rank", "_rn").exceptAll(want.select("site", "rank", "_rn")).count() == 0
    assert got.count() == 20000
