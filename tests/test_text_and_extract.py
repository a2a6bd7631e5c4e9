"""Normalization, hashing and extraction on small inputs."""

import hashlib
import random
import unicodedata

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.extract import extract_pages, pipeline_pages

WHITESPACE = [c for c in map(chr, range(0x3001)) if c.isspace()]


from tidemark.functions import html as H  # noqa: E402


def py_normalize(s: str) -> str:
    """The normalization rules stated directly in Python."""
    s = s.replace("\r\n", "\n").replace("\r", "\n")
    out = []
    for line in s.split("\n"):
        collapsed, prev_blank = [], False
        for ch in line:
            if ch in " \t":
                if not prev_blank:
                    collapsed.append(" ")
                prev_blank = True
            else:
                collapsed.append(ch)
                prev_blank = False
        out.append("".join(collapsed).rstrip())
    s = "\n".join(out)
    while "\n\n\n" in s:
        s = s.replace("\n\n\n", "\n\n")
    return s.strip()


def _random_texts(n, seed=7):
    rnd = random.Random(seed)
    alphabet = list("abcXYZ #-.é") + WHITESPACE + ["\r\n", "\n\n\n", "\t\t"]
    return [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))),) for _ in range(n)]


def test_whitespace_class_is_pythons():
    assert len(WHITESPACE) == 29


def test_normalize_matches_rules_on_random_texts(spark):
    rows = _random_texts(1500)
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", T.normalize("t").alias("n"), T.token_estimate("t").alias("k"),
                    T.text_hash("t").alias("h")).collect()
    for r in got:
        want = py_normalize(r.t)
        assert r.n == want, repr(r.t)
        assert r.k == len(r.t.split())
        assert r.h == "sha256:" + hashlib.sha256(want.encode()).hexdigest()


def test_normalize_is_idempotent(spark):
    df = spark.createDataFrame(_random_texts(300, seed=3), "t string")
    bad = df.select(T.normalize("t").alias("a")).where(T.normalize("a") != F.col("a")).count()
    assert bad == 0


def test_slug(spark):
    cases = {"Getting Started": "getting-started", "  API keys!! ": "api-keys", "Привет": "section",
             "A 1": "a-1", "--x--": "x", "": "section", "C++ & Go": "c-go"}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r.h: r.s for r in df.select("h", T.slug("h").alias("s")).collect()}
    assert got == cases


PAGE = """<html><head><title>Guide  Title</title></head><body>
<nav><a href="/a">Home</a> <a href="/b">Docs</a></nav>
<header>Site header text</header>
<main><h1>Welcome</h1><p>First paragraph with   some text.</p><h2>Details</h2><p>Second paragraph.</p></main>
<footer>Footer text</footer><aside>Sidebar text</aside>
<script>var t="</p>";</script></body></html>"""


def _raw(spark, html, url="https://docs.example.com/guide"):
    return spark.createDataFrame([(url, html, 200, "2026-01-01T00:00:00Z", 0)],
                                 "url string, raw_html string, status int, fetched_at string, depth int")


def test_boilerplate_removed_and_fields_passed(spark):
    p = extract_pages(_raw(spark, PAGE)).first()
    for gone in ("Site header text", "Footer text", "Sidebar text", "Home", 'var t'):
        assert gone not in p.markdown
    assert "First paragraph with some text." in p.markdown and "Second paragraph." in p.markdown
    assert p.markdown.startswith("# Welcome") and "## Details" in p.markdown
    assert p.title == "Welcome"
    assert (p.url, p.status, p.depth, p.fetched_at) == ("https://docs.example.com/guide", 200, 0, "2026-01-01T00:00:00Z")
    assert p.content_hash.startswith("sha256:") and len(p.content_hash) == 71


def test_hash_ignores_reformatting(spark):
    variant = PAGE.replace("\n", "\r\n").replace("First paragraph with", "First    paragraph   with") \
        .replace("</p><h2>", "</p>\r\n\r\n\r\n\r\n<h2>")
    a = extract_pages(_raw(spark, PAGE)).first()
    b = extract_pages(_raw(spark, variant)).first()
    c = extract_pages(_raw(spark, PAGE)).first()
    assert a.content_hash == b.content_hash == c.content_hash


def test_fallback_and_title_precedence(spark):
    only_nav = "<html><head><title>  Just\n a   title </title></head><body><nav>Menu item</nav></body></html>"
    p = extract_pages(_raw(spark, only_nav)).first()
    assert p.markdown == "Just a title\n\nMenu item"   # main content empty -> whole document
    assert p.title == "Just a title"            # no heading -> <title>, whitespace collapsed
    og = '<html><head><meta property="og:title" content=" OG name "><title>T</title></head><body><article>' \
         '<h1>Head</h1><p>x</p></article></body></html>'
    assert extract_pages(_raw(spark, og)).first().title == "OG name"
    none = "<html><body><p>text only</p></body></html>"
    assert extract_pages(_raw(spark, none)).first().title == ""


def test_entities_and_lists(spark):
    html = ("<article><p>a &amp;lt; b &#233; &#x263A; &copy;</p><ul><li>one</li><li>two</li></ul>"
            "<p>x<br>y</p></article>")
    md = extract_pages(_raw(spark, html)).first().markdown
    assert md == "a &lt; b é ☺ ©\n\n- one\n- two\n\nx\ny"


def test_blank_pages_dropped_once(spark):
    blank = "<html><body><article> </article><nav> </nav></body></html>"
    raw = spark.createDataFrame(
        [("https://docs.example.com/guide", PAGE, 200, "t", 0), ("https://docs.example.com/blank", blank, 200, "t", 0)],
        "url string, raw_html string, status int, fetched_at string, depth int")
    out = pipeline_pages(raw)
    assert [r.url for r in out.collect()] == ["https://docs.example.com/guide"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(?is)<script") == 1       # the extraction chain is evaluated once


def test_unicode_whitespace_in_heading_and_strip(spark):
    s = "　 title  "
    df = spark.createDataFrame([(s,)], "t string")
    assert df.select(T.strip_ws("t")).first()[0] == s.strip()
    assert unicodedata.category(" ") == "Zl"


def test_python_extractor_hook(spark):
    def extractor(html):
        return "# From hook\n\n" + ("body   text  " if "main" in html else "")

    p = extract_pages(_raw(spark, PAGE), extractor=extractor).first()
    assert p.markdown == "# From hook\n\nbody text" and p.title == "From hook"
    empty = extract_pages(_raw(spark, "<html><body><p>x</p></body></html>"), extractor=lambda h: None).first()
    assert empty.markdown == "x"          # hook found nothing: whole-document fallback


def _markdown(spark, pages):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    return [r.m for r in df.select("i", H.page_markdown("h").alias("m")).orderBy("i").collect()]


def test_no_part_of_the_content_is_lost(spark):
    got = _markdown(spark, [
        "<main><article>one</article><article>two</article>tail</main>",
        "<body>x<article>first</article><p>between</p><article>last</article>y</body>",
        "<article>outer <article>inner</article> rest</article>",
        "<body><header><header>in</header> furniture</header><p>kept</p><nav>a<nav>b</nav>c</nav></body>",
        "<main><pre>for x in y:\n    go(x)\n\ndone()</pre><p>prose\nstays one line</p></main>"])
    assert got == ["one\n\ntwo\n\ntail", "first\n\nbetween\n\nlast", "outer\n\ninner\n\nrest", "kept",
                   "for x in y:\n go(x)\n\ndone()\n\nprose stays one line"]


def test_references_against_stdlib(spark):
    import html
    import random
    from html.entities import html5

    rnd = random.Random(4)
    names = sorted(n for n in html5 if n.endswith(";"))
    parts = ["&amp;", "&#38;", "&#x26;", "amp;", "&", "x", " ", "&nosuch;", "&#128;", "&#x80;", "&#0065;", "&AMP;"]
    texts = ["".join(rnd.choice(parts) if rnd.random() < 0.6 else "&" + rnd.choice(names) for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    # without names that the standard library also decodes when their semicolon is missing
    texts = [t for t in texts if not any(t.find("&" + n, 0) >= 0 and "&" + n + ";" not in t for n in html5 if not n.endswith(";"))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", H.decode_entities("t").alias("d")).collect():
        if "&nosuch" not in r.t:
            assert r.d == html.unescape(r.t), r.t
