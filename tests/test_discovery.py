"""Robots, URL resolution, globs, sitemaps, fetch log links and a small crawl."""

import random
import urllib.robotparser
from fnmatch import fnmatchcase
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from tidemark.functions import urls as U
from tidemark.operators import discover as X
from tidemark.sources import discovery as SD

AGENT = "tidemark"


def _random_robots(rnd):
    lines = []
    for _ in range(rnd.randint(0, 12)):
        kind = rnd.random()
        if kind < 0.25:
            lines.append(f"User-agent: {rnd.choice(['*', 'tidemark', 'other', 'TideMark', 'mark', 'x'])}")
        elif kind < 0.55:
            lines.append(f"Disallow: {rnd.choice(['/a', '/a/b', '/', '', '/c?x=1', '*', '/b'])}")
        elif kind < 0.7:
            lines.append(f"Allow: {rnd.choice(['/a/b', '/', '/b', '/c'])}")
        elif kind < 0.8:
            lines.append("")
        elif kind < 0.85:
            lines.append("# comment")
        elif kind < 0.9:
            lines.append("Crawl-delay: 5")
        else:
            lines.append(rnd.choice(["Sitemap: https://h/s.xml", "nonsense", "  ", "Disallow: /b # note"]))
    return "\n".join(lines)


def test_robots_against_stdlib(spark):
    rnd = random.Random(5)
    files = [(f"h{i}.example.com", _random_robots(rnd)) for i in range(400)]
    paths = ["/", "/a", "/a/b", "/a/bc", "/b", "/c?x=1", "/c?x=2", "/d"]
    robots = spark.createDataFrame(files, "host string, text string")
    urls = spark.createDataFrame([(f"https://{h}{p}",) for h, _ in files for p in paths], "url string")
    got = {r.url: r.robots_ok for r in X.robots_allowed(urls, SD.robots_rules(robots, AGENT)).collect()}
    denied = 0
    for host, text in files:
        rp = urllib.robotparser.RobotFileParser()
        rp.parse(text.splitlines())
        for p in paths:
            u = f"https://{host}{p}"
            want = rp.can_fetch(AGENT + "/1.0", u)
            denied += not want
            assert got[u] == want, (text, p)
    assert denied > 100


def test_resolve_against_urljoin(spark):
    bases = ["https://h.example.com/a/b/c", "http://h.example.com/", "https://h.example.com/a/b/?q=1#f",
             "https://h.example.com/x.html"]
    hrefs = ["/d", "d", "./d", "../d", "../../../d", "?y=2", "#frag", "//o.example.com/p", "HTTPS://h.example.com/Z",
             "mailto:x@y", "", "d/./e/../f", "/a/../b/", "  /sp ", "e?x=1#k", "..", "."]
    rows = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", U.defrag(U.resolve(F.col("b"), F.col("h"))).alias("r")).collect()
    for r in got:
        assert r.r == urldefrag(urljoin(r.b, r.h))[0], (r.b, r.h)


def test_globs_against_fnmatch(spark):
    globs = ["/docs/*", "*.html", "/a?c", "/[ab]*", "/[!x]*", "*", "/blog/*/2024*", "/a[*]b", "/a[?]b", "/a[b", "/x[&&]y", "/[]a]", "/[!]a]",
             "/[b-a]", "/[a-c-e]", "/[^a]", "/a\\b", "/(a|b)", "/[[]", "/[a", "[", "/a.b", "/{a}", "/[a-]"]
    paths = ["/docs/x", "/docs", "/x.html", "/abc", "/a/c", "/bz", "/xz", "/blog/a/2024-01", "/", "/Docs/x", "/a.b", "/a*b", "/a?b", "/a[b",
             "/x&y", "/]", "/a", "/b", "/-", "/^", "/a\\b", "/(a|b)", "/[", "[", "/{a}", "/axb"]
    rnd = random.Random(3)
    globs += ["".join(rnd.choice("/ab*?[]!-^&.") for _ in range(rnd.randint(1, 7))) for _ in range(150)]
    paths += ["".join(rnd.choice("/ab-^&.!]") for _ in range(rnd.randint(0, 5))) for _ in range(60)]
    sites = spark.createDataFrame([(g, [g], [g]) for g in sorted(set(globs))], "g string, include array<string>, exclude array<string>")
    df = X.site_globs(sites).crossJoin(spark.createDataFrame([(x,) for x in sorted(set(paths))], "p string"))
    none = F.lit(None).cast("array<string>")
    got = df.select("p", "g", X.glob_ok(F.col("p"), F.col("include"), none).alias("inc"), X.glob_ok(F.col("p"), none, F.col("exclude")).alias("exc")).collect()
    for r in got:
        assert r.inc == fnmatchcase(r.p, r.g) and r.exc == (not fnmatchcase(r.p, r.g)), (r.p, r.g)


def test_sitemaps(spark):
    head = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:v="http://example.org/v">'
    docs = [("plain.example.net", head + "<url><loc> https://plain.example.net/ </loc></url><url><v:loc>https://plain.example.net/v</v:loc></url><url><loc></loc></url></urlset>"),
            ("refs.example.net", head + "<url><loc>https://refs.example.net/a?x=1&amp;y=&#50;</loc></url></urlset>"),
            ("cdata.example.net", head + "<url><loc><![CDATA[https://cdata.example.net/?a&b]]></loc></url><!-- <loc>https://cdata.example.net/no</loc> --></urlset>"),
            ("broken.example.net", head + "<url><loc>https://broken.example.net/</loc></url>"),
            ("empty.example.net", ""), ("null.example.net", None),
            ("many.example.net", head + "".join(f"<url><loc>https://many.example.net/{i}</loc></url>" for i in range(150)) + "</urlset>")]
    rows = SD.sitemap_urls(spark.createDataFrame(docs, "host string, xml string")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.host, r.pos)):
        got.setdefault(r.host, []).append(r.url)
    assert got["plain.example.net"] == ["https://plain.example.net/", "https://plain.example.net/v"]
    assert got["refs.example.net"] == ["https://refs.example.net/a?x=1&y=2"]
    assert got["cdata.example.net"] == ["https://cdata.example.net/?a&b"]
    assert set(got) == {"plain.example.net", "refs.example.net", "cdata.example.net", "many.example.net"}
    assert got["many.example.net"] == [f"https://many.example.net/{i}" for i in range(150)]


def test_fetch_log(spark):
    log = spark.createDataFrame([("u1", 1, 503), ("u1", 2, 200), ("u2", 1, None), ("u2", 2, 500), ("u2", 3, 502),
                                 ("u3", 1, 500), ("u3", 2, None), ("u3", 3, None), ("u4", 1, 404)],
                                "url string, attempt int, status int")
    got = {r.url: (r.status, r.attempt) for r in X.fetch_log_resolved(log).collect()}
    assert got == {"u1": (200, 2), "u2": (502, 3), "u4": (404, 1)}


G = "https://garden.example.org"


def _garden(spark, max_pages=None, include=None, exclude=None, respect=True):
    """A seed shop: beds and tools linked from home, a shed behind robots, a page only the sitemap knows, a dead link."""
    responses = spark.createDataFrame([(G + p, c) for p, c in (("/", 200), ("/beds", 200), ("/tools", 200), ("/beds/peas", 200),
                                                               ("/shed", 200), ("/lost", 200), ("/dead", 404))], "url string, status int")
    links = spark.createDataFrame([(G + "/", 0, G + "/tools"), (G + "/", 1, G + "/dead"), (G + "/", 2, G + "/beds"), (G + "/", 3, G + "/shed"),
                                   (G + "/beds", 0, G + "/beds/peas"), (G + "/beds", 1, G + "/"), (G + "/tools", 0, "https://else.example.org/")],
                                  "src_url string, pos int, dst_url string")
    sites = spark.createDataFrame([(G + "/", max_pages, include, exclude, respect)],
                                  "start_url string, max_pages int, include array<string>, exclude array<string>, respect_robots boolean")
    rules = SD.robots_rules(spark.createDataFrame([("garden.example.org", "User-agent: *\nDisallow: /shed\n")], "host string, text string"), AGENT)
    listed = "".join(f"<url><loc>{G}{p}</loc></url>" for p in ("/tools", "/lost"))
    sm = SD.sitemap_urls(spark.createDataFrame([("garden.example.org", f"<urlset>{listed}</urlset>")], "host string, xml string"))
    return {r.url.removeprefix(G): (r.depth, r.seq, r.status) for r in X.site_bfs(responses, links, sites, rules, sm).collect()}


def test_garden_walk(spark):
    whole = {"/": (0, 1, 200), "/tools": (1, 2, 200), "/dead": (1, 3, 404), "/beds": (1, 4, 200), "/beds/peas": (2, 5, 200), "/lost": (0, 6, 200)}
    assert _garden(spark) == whole
    assert _garden(spark, max_pages=3) == {u: r for u, r in whole.items() if r[1] <= 3}
    assert _garden(spark, exclude=["/beds*"]) == {"/": (0, 1, 200), "/tools": (1, 2, 200), "/dead": (1, 3, 404), "/lost": (0, 4, 200)}
    assert _garden(spark, include=["/t*"]) == {"/": (0, 1, 200), "/tools": (1, 2, 200)}
    assert "/shed" in _garden(spark, respect=False)


def test_links_against_a_parser(spark):
    class Anchors(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            href = dict(reversed(attrs)).get("href")
            if tag == "a" and href:
                self.found.append(href)

    rnd = random.Random(9)
    values = ["/a", "/b?x=1&amp;y=2", "t href=/no", "a > b", "/q&#38;z", "it's", "/&eacute;", "/x y"]

    def attribute():
        name, v = rnd.choice(["href", "title", "data-href", "HREF", "class", "hreflang"]), rnd.choice(values)
        bare = all(c not in v for c in " >'")
        return rnd.choice([f'{name}="{v}"', f"{name} = '{v}'" if "'" not in v else f'{name}="{v}"', f"{name}={v}" if bare else f'{name}="{v}"', "hidden"])

    pages = []
    for i in range(200):
        tags = [f"<{rnd.choice(['a', 'A', 'abbr', 'a', 'p'])} {' '.join(attribute() for _ in range(rnd.randint(0, 3)))}>text" for _ in range(rnd.randint(0, 5))]
        pages.append((f"https://h.example.org/{i}", "".join(tags) + "<!-- <a href='/c'> -->"))
    got = {}
    for r in X.page_links(spark.createDataFrame(pages, "url string, html string")).orderBy("src_url", "pos").collect():
        got.setdefault(r.src_url, []).append(r.href)
    for url, text in pages:
        parser = Anchors()
        parser.feed(text)
        assert got.get(url, []) == parser.found, text
