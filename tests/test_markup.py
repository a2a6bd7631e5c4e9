"""Lists, tables, code, link targets and metadata titles against Python's HTML parser."""

import random
import re
from html.parser import HTMLParser

from tidemark.functions import html as H
from tidemark.operators.extract import extract_pages


class Plain(HTMLParser):
    """Markdown of a document of lists, tables, paragraphs and code, event by event."""

    def __init__(self, text, links=False):
        super().__init__(convert_charrefs=True)
        self.out, self.lists, self.rows, self.links, self.href = [""], [], None, links, None
        self.feed(text)
        self.close()

    def markdown(self):
        lines = [re.sub(r"[ \t]+", " ", line).strip().replace("\0", "  ") for line in "".join(self.out).split("\n")]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()

    def handle_starttag(self, tag, attrs):
        if self.rows is not None:
            if tag == "tr":
                self.rows.append([])
            elif tag in ("td", "th"):
                self.rows[-1].append("")
            elif tag in ("p", "br"):
                self.handle_data(" ")
            elif tag == "code":
                self.handle_data("`")
        elif tag in ("ul", "ol"):
            if not self.lists:
                self.out.append("\n\n")
            self.lists.append(0 if tag == "ol" else None)
        elif tag == "li":
            if self.lists[-1] is not None:
                self.lists[-1] += 1
            bullet = "- " if self.lists[-1] is None else f"{self.lists[-1]}. "
            self.out.append("\n" + "\0" * (len(self.lists) - 1) + bullet)
        elif tag == "table":
            self.out.append("\n\n")
            self.rows = []
        elif tag == "p":
            self.out.append("\n\n")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "code":
            self.out.append("`")
        elif tag == "a" and self.links and dict(attrs).get("href"):
            self.href = dict(attrs)["href"]
            self.out.append("[")

    def handle_endtag(self, tag):
        if tag == "table":
            for i, row in enumerate(self.rows):
                cells = [re.sub(r"\s+", " ", c).strip().replace("|", "\\|") for c in row]
                self.out.append("\n| " + " | ".join(cells) + " |" + ("\n|" + " --- |" * len(row) if i == 0 else ""))
            self.rows = None
            self.out.append("\n\n")
        elif self.rows is not None:
            self.handle_data({"p": " ", "code": "`"}.get(tag, ""))
        elif tag in ("ul", "ol"):
            self.lists.pop()
            if not self.lists:
                self.out.append("\n\n")
        elif tag == "p":
            self.out.append("\n\n")
        elif tag == "code":
            self.out.append("`")
        elif tag == "a" and self.href:
            self.out.append(f"]({self.href})")
            self.href = None

    def handle_data(self, data):
        data = re.sub(r"\s+", " ", data)
        if self.rows is not None:
            if self.rows and self.rows[-1]:
                self.rows[-1][-1] += data
        else:
            self.out.append(data)


def _words(rnd):
    return " ".join(rnd.choice(["red", "blue", "a&amp;b", "x|y", "<b>bold</b>", "<code>f()</code>", "&lt;i&gt;"]) for _ in range(rnd.randint(1, 3)))


def _list(rnd, depth=0):
    kind = rnd.choice(["ul", "ol"])
    items = ""
    for _ in range(rnd.randint(1, 3)):
        items += rnd.choice(["<li>", '<li class="k">', "<LI>"]) + _words(rnd)
        if depth < 3 and rnd.random() < 0.4:
            items += rnd.choice(["", " ", "\n"]) + _list(rnd, depth + 1)
        items += rnd.choice(["</li>", "</li>\n", ""])
    return f"<{kind}>{items}</{kind}>"


def _table(rnd):
    rows = ""
    for i in range(rnd.randint(1, 3)):
        tag = "th" if i == 0 else "td"
        cells = "".join(f"<{tag}>{_words(rnd)}" + rnd.choice([f"</{tag}>", "", f"<br>{_words(rnd)}</{tag}>"]) for _ in range(rnd.randint(1, 4)))
        rows += f"<tr>{cells}" + rnd.choice(["</tr>", "</tr>\n", ""])
    return f"<table>{rnd.choice(['', '<tbody>'])}{rows}</table>"


def _documents(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        yield "".join(rnd.choice([_list, _table, lambda r: f"<p>{_words(r)}</p>", lambda r: f"<p>{_words(r)}<br>{_words(r)}</p>\n"])(rnd) for _ in range(rnd.randint(1, 4)))


def _converted(spark, docs, **kw):
    df = spark.createDataFrame(list(enumerate(docs)), "i int, h string")
    return [r.m for r in df.select("i", H.fragment_to_markdown("h", **kw).alias("m")).orderBy("i").collect()]


def test_random_lists_and_tables(spark):
    docs = list(_documents(250, 4))
    for doc, got in zip(docs, _converted(spark, docs), strict=True):
        assert got == Plain(doc).markdown(), doc


def test_link_targets(spark):
    rnd = random.Random(9)
    docs = []
    for _ in range(100):
        anchors = [rnd.choice(['<a href="/x?a=1&amp;b=2">', "<A class=k HREF='y z'>", "<a href=z>", "<a name=n>", '<a title="href=no" href="/t>u">']) + rnd.choice(["word", "<b>two</b> words"]) + "</a>"
                   for _ in range(rnd.randint(1, 4))]
        docs.append("<p>" + " and ".join(anchors) + "</p><ul><li>" + anchors[0] + "</ul>")
    for doc, got in zip(docs, _converted(spark, docs, links=True), strict=True):
        assert got == Plain(doc, links=True).markdown(), doc
    assert "](" not in "".join(_converted(spark, docs))


def test_malformed_lists_and_tables(spark):
    docs = ["</ul></li>x<li>stray", "<table>no rows</table>x", "<ul><table><tr><td>in a list</ul>", "<tr><td>outside</td></tr>", "<table><tr><td>open", "<ol></ol>", "<table><tr></tr><tr><td>a</table>",
            "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>", None]
    got = _converted(spark, docs)
    assert got[-1] is None and got[1] == "no rows\n\nx" and got[3] == "outside"
    assert got[4] == "| open" and got[6] == "| a |\n| --- |" and got[7] == "| a in | b |\n| --- | --- |"


def test_code_in_running_text_only(spark):
    assert _converted(spark, ["<p>call <code>f(x)</code></p><pre><code>a\nb</code></pre>"]) == ["call `f(x)`\n\na\nb"]


def _raw(spark, pages):
    return spark.createDataFrame([(f"https://w.example.org/{i}", h, 200, "t", 0) for i, h in enumerate(pages)], "url string, raw_html string, status int, fetched_at string, depth int")


def test_hash_sees_content_not_indentation(spark):
    pages = ["<main><ul><li>a<ul><li>b</li></ul></li></ul></main>", "<main>\n <ul>\n  <li>a\n <ul>\n<li>b</li></ul>\n</li></ul></main>"]
    a, b = extract_pages(_raw(spark, pages)).orderBy("url").collect()
    assert a.markdown == b.markdown == "- a\n  - b" and a.content_hash == b.content_hash


def test_only_the_fallback_shows_targets(spark):
    pages = ['<main><p>see <a href="/x">there</a></p></main>', '<body><nav><a href="/x">there</a></nav></body>']
    assert [r.markdown for r in extract_pages(_raw(spark, pages)).orderBy("url").collect()] == ["see there", "[there](/x)"]


# --- titles ------------------------------------------------------------------------------------


class Metas(HTMLParser):
    def __init__(self, text):
        super().__init__()
        self.found = []
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        if tag == "meta":
            first = {}
            for k, v in attrs:
                first.setdefault(k, v or "")
            self.found.append(first)

    def title(self):
        for key, name in (("property", "og:title"), ("name", "title"), ("name", "dc.title"), ("name", "twitter:title")):
            for tag in self.found:
                if tag.get(key, "").strip().lower() == name and tag.get("content", "").strip():
                    return tag["content"].strip()
        return ""


def test_metadata_titles(spark):
    rnd = random.Random(2)
    docs = []
    for _ in range(300):
        tags = []
        for _ in range(rnd.randint(0, 4)):
            key = rnd.choice(["property", "name", "PROPERTY", "Name"])
            what = rnd.choice(["og:title", "title", "DC.title", "twitter:title", "og:type", "og:title"])
            text = rnd.choice(["A &amp; B", "plain", " spaced  out ", "", "caf&eacute;", "a > b", "x=y"])
            quote = rnd.choice(['"', "'"])
            attrs = [f"{key}={rnd.choice([quote + what + quote, what])}", rnd.choice([f"content={quote}{text}{quote}", f"CONTENT = {quote}{text}{quote}", "content=bare"]),
                     rnd.choice(["charset=utf-8", "data-x", 'content="second"'])]
            if "second" not in attrs[2]:
                rnd.shuffle(attrs)
            tags.append(rnd.choice(["<meta ", "<META\n"]) + " ".join(attrs) + rnd.choice([">", "/>", " />"] if not attrs[-1].endswith(("bare", "title", "type", "utf-8")) else [">", " />"]))
        docs.append("<head>" + "".join(tags) + "<title>t</title></head>")
    df = spark.createDataFrame(list(enumerate(docs)), "i int, h string")
    for r in df.select("i", "h", H.meta_title("h").alias("t")).collect():
        assert r.t == Metas(r.h).title(), r.h


def test_titles_from_json_ld_and_comments(spark):
    docs = ['<!-- <meta property="og:title" content="no"> --><script type="application/ld+json">{"headline": "Caf\\u00e9 \\"Sol\\""}</script>',
            '<script type="application/ld+json">[{"headline": "First"}]</script>', '<script type="application/ld+json">{broken</script>', None]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, h string")
    assert [r.t for r in df.select("i", H.meta_title("h").alias("t")).orderBy("i").collect()] == ['Café "Sol"', "First", "", ""]
