"""HTML column functions: main content as markdown, title, links.

A fixed chain of ``regexp_replace`` calls turns a page into markdown without
a parser: boilerplate blocks go, the ``<article>``/``<main>`` parts (or the
body) stay, headings become ATX lines, block tags paragraph breaks, list
items indented ``- `` or numbered lines, table rows lines with bars, inline code
goes between backticks, other tags vanish and entities are decoded.  No row
leaves the JVM.  The chain runs in generated code, except for the steps that
need a higher-order function (entities, preformatted and nested blocks, lists, tables),
which only texts that hold such markup go through.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, normalize, strip_ws

# Blocks removed everywhere before conversion.
SCRIPT_LIKE = ("script", "style")
# Page furniture dropped from the main-content view.
BOILERPLATE = ("nav", "header", "footer", "aside")
# Tags that end a paragraph.
BLOCK_TAGS = (
    "p", "div", "section", "article", "main", "header", "footer", "nav", "aside",
    "ul", "ol", "table", "thead", "tbody", "tfoot", "blockquote", "pre", "figure",
    "figcaption", "dl", "dt", "dd", "form", "hr", "address", "details", "summary",
)
# Stands for a line break of preformatted text until the other line breaks are settled.
PRE_BREAK = "\ue000"
# Stands for one level of a nested list until the text is normalized.
INDENT = "\ue001"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _drop_block(t: Column, tag: str) -> Column:
    """Without ``<tag>...</tag>`` blocks; blocks inside one another go together."""
    def outside(x):
        flat = F.regexp_replace(x, rf"(?is)<{tag}\b.*?</{tag}[^>]*>", "")
        # an end tag left over belongs to a block that held another one
        return _let(flat, lambda y: F.when(F.regexp_like(y, F.lit(rf"(?i)</{tag}\b")), _drop_nested(x, tag)).otherwise(y))

    return _let(t, outside)


def _drop_nested(t: Column, tag: str) -> Column:
    """Text outside all ``tag`` blocks, counting how deep each piece lies."""
    pieces = F.split(t, rf"(?i)(?=<{tag}\b)|(?=</{tag}\b)")
    opens, closes = rf"(?i)^<{tag}\b", rf"(?i)^</{tag}\b"
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))

    def step(acc, piece):
        opened, closed = F.regexp_like(piece, F.lit(opens)), F.regexp_like(piece, F.lit(closes))
        depth = F.when(opened, acc["depth"] + 1).when(closed, F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        rest = F.when(closed, F.regexp_replace(piece, r"(?s)^[^>]*>?", "")).otherwise(piece)
        return F.struct(depth.alias("depth"), F.when(depth == 0, F.concat(acc["text"], rest)).otherwise(acc["text"]).alias("text"))

    return F.aggregate(pieces, start, step)["text"]


def strip_code(html) -> Column:
    """Remove comments, scripts and styles (their text is never content)."""
    t = F.regexp_replace(_col(html), r"(?s)<!--.*?-->", "")
    for tag in SCRIPT_LIKE:
        t = _drop_block(t, tag)
    return t


def strip_boilerplate(html) -> Column:
    t = _col(html)
    for tag in BOILERPLATE:
        t = _drop_block(t, tag)
    return t


# One character reference, or a run of text without any.
_REFERENCE = r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});|[^&]+|&"


def _named_references() -> Column:
    """HTML's named references (those written with a semicolon) as a constant map."""
    pairs = "\x01".join(f"&{name}\x02{chars}" for name, chars in sorted(html5.items()) if name.endswith(";"))
    return F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))


def decode_entities(c) -> Column:
    """Every character reference that ends in a semicolon, decoded once; unknown names stay as they are.

    One pass over the text's references, so a decoded ``&`` never starts
    another one.  Numbers 128 to 159 mean their windows-1252 characters, as
    in HTML; numbers that are no characters become U+FFFD.
    """
    names = _named_references()

    def decode(x):
        decimal = F.regexp_extract(x, r"^&#0*([0-9]{1,7});$", 1)
        hexed = F.regexp_extract(x, r"^&#[xX]0*([0-9a-fA-F]{1,6});$", 1)
        number = F.when(decimal != "", decimal.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        return F.when(~x.startswith("&") | (x == "&"), x).when(x.startswith("&#"), _let(number, _code_point)) \
            .otherwise(F.coalesce(F.try_element_at(names, x), x))

    def decoded(t):
        pieces = F.regexp_extract_all(t, F.lit(_REFERENCE), 0)
        return F.when(F.regexp_like(t, F.lit(r"&[#A-Za-z]")), F.array_join(F.transform(pieces, decode), "")).otherwise(t)

    return _let(_col(c), decoded)


def _windows_1252() -> Column:
    """Characters for the numbers 128 to 159."""
    return F.array(*[F.lit(bytes([n]).decode("cp1252", "ignore") or chr(n)) for n in range(128, 160)])


def _code_point(cp: Column) -> Column:
    """Character for a Unicode code point (U+FFFD when out of range)."""
    valid = (cp > 0) & (cp <= 0x10FFFF) & ~((cp >= 0xD800) & (cp <= 0xDFFF))
    ch = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return F.when(cp.between(128, 159), F.element_at(_windows_1252(), cp - 127)).when(valid, ch).otherwise(F.lit("\ufffd"))


def fragment_to_markdown(html, links: bool = False) -> Column:
    """Convert an HTML fragment to markdown; with ``links`` anchors keep their targets."""
    return finish_markdown(decode_entities(tags_to_markdown(html, links)))


def tags_to_markdown(html, links: bool = False) -> Column:
    """Tags to markdown structure: headings, paragraphs, lists, tables, line breaks, code; other tags dropped."""
    t = F.regexp_replace(_keep_lines(_col(html)), r"[ \t\n\r\f]+", " ")
    if links:
        t = _link_targets(t)
    t = _let(t, lambda x: F.when(F.regexp_like(x, F.lit(r"(?i)<(?:ul|ol|table)\b")), _lists_and_tables(x)).otherwise(x))
    for level in range(1, 7):
        t = F.regexp_replace(t, rf"(?i)<h{level}\b[^>]*>", "\n\n" + "#" * level + " ")
    t = F.regexp_replace(t, r"(?i)</h[1-6]\s*>", "\n\n")
    t = F.regexp_replace(t, r"(?i)<br\b[^>]*>", "\n")
    t = F.regexp_replace(t, r"(?i)<li\b[^>]*>", "\n- ")
    t = F.regexp_replace(t, r"(?i)</t[dh]\s*>", " ")
    t = F.regexp_replace(t, r"(?i)</?tr\b[^>]*>", "\n")
    t = F.regexp_replace(t, r"(?i)</?code\b[^>]*>", "`")
    t = F.regexp_replace(t, rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})\b[^>]*>", "\n\n")
    return F.regexp_replace(t, r"</?[A-Za-z!][^>]*>", "")


# Tags that the fold over lists and tables stops at.
_STRUCTURE = r"(?:ul|ol|li|table|tr|td|th)"


def _lists_and_tables(t: Column) -> Column:
    """Lists by their depth and number, tables as rows with bars: one fold over their tags with a stack of open lists.

    The fold keeps a short prefix for each piece of text, so its state stays
    small; the pieces are put together once, after it.  A list item's number is
    on the stack (-1 in an unordered list).  Tables inside cells, and blocks
    inside cells, become running text.  End tags may be missing as HTML allows.
    """
    pieces = F.split(t, rf"(?i)(?=</?{_STRUCTURE}\b)")
    mark = F.struct(F.lit("").alias("before"), F.lit(False).alias("cell"))
    start = F.struct(F.lit(None).cast("array<int>").alias("lists"), F.lit(0).alias("tables"), F.lit(0).alias("rows"), F.lit(0).alias("cells"),
                     F.filter(F.array(mark), lambda m: F.lit(False)).alias("out"))
    start = start.withField("lists", F.filter(F.array(F.lit(0)), lambda x: F.lit(False)))

    def step(acc, piece):
        tag = F.lower(F.regexp_extract(piece, rf"(?i)^<(/?{_STRUCTURE})\b", 1))
        lists, depth = acc["lists"], F.size(acc["lists"])
        inside, outer = acc["tables"] > 0, acc["tables"] == 1
        opens, closes = tag.isin("ul", "ol") & ~inside, tag.isin("/ul", "/ol") & ~inside & (depth > 0)
        item = (tag == "li") & ~inside
        counter = F.when(depth > 0, F.try_element_at(lists, F.lit(-1))).otherwise(-1)
        number = F.when(counter >= 0, counter + 1).otherwise(-1)
        kept = F.slice(lists, 1, F.greatest(depth - 1, F.lit(0)))
        new_lists = (F.when(opens, F.concat(lists, F.array(F.when(tag == "ol", 0).otherwise(-1))))
                     .when(closes, kept).when(item & (depth > 0), F.concat(kept, F.array(number))).otherwise(lists))
        tables = F.when(tag == "table", acc["tables"] + 1).when(tag == "/table", F.greatest(acc["tables"] - 1, F.lit(0))).otherwise(acc["tables"])
        cell = tag.isin("td", "th") & outer
        row_ends = outer & (acc["cells"] > 0) & (tag.isin("tr", "/tr") | (tag == "/table"))
        rule = F.when(acc["rows"] == 0, F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), acc["cells"]))).otherwise("")
        end = F.when(row_ends, F.concat(F.lit(" |"), rule)).otherwise("")
        before = (F.when((opens | closes) & (F.size(new_lists) + depth == 1), F.lit("\n\n"))
                  .when(item, F.concat(F.lit("\n"), F.repeat(F.lit(INDENT), F.greatest(depth - 1, F.lit(0))),
                                       F.when(number >= 0, F.concat(number.cast("string"), F.lit(". "))).otherwise("- ")))
                  .when(cell, F.when(acc["cells"] == 0, F.lit("\n| ")).otherwise(F.lit(" | ")))
                  .when((tag == "table") & ~inside, F.lit("\n\n")).when((tag == "/table") & outer, F.concat(end, F.lit("\n\n")))
                  .when(row_ends, end).when(inside & (tag != ""), F.lit(" ")).otherwise(""))
        cells = F.when(cell, acc["cells"] + 1).when(row_ends | ((tag == "table") & ~inside), 0).otherwise(acc["cells"])
        rows = F.when((tag == "table") & ~inside, 0).when(row_ends, acc["rows"] + 1).otherwise(acc["rows"])
        told = F.struct(before.alias("before"), ((tables > 0) & (cells > 0)).alias("cell"))
        return F.struct(new_lists.alias("lists"), tables.alias("tables"), rows.alias("rows"), cells.alias("cells"), F.array_append(acc["out"], told).alias("out"))

    def told(piece, m):
        rest = F.regexp_replace(piece, rf"(?is)^</?{_STRUCTURE}\b[^>]*>?", "")
        flat = F.regexp_replace(F.regexp_replace(rest, rf"(?i)<(?:/?(?:{'|'.join(BLOCK_TAGS)}|h[1-6])|br)\b[^>]*>", " "), r"\|", r"\\|")
        lone = F.regexp_replace(F.regexp_replace(rest, r"(?i)^ *<p\b[^>]*>", ""), r"(?i)</p\s*> *$", "")
        body = F.when(m["cell"], F.regexp_replace(flat, r"^ +| +$", "")).when(m["before"].rlike(r"(?:- |\d\. )$"), lone).otherwise(rest)
        return F.concat(m["before"], body)

    def joined(parts):
        marks = F.aggregate(parts, start, step)["out"]
        return F.array_join(F.zip_with(parts, marks, told), "")

    return _let(pieces, joined)


def _link_targets(t: Column) -> Column:
    """``<a href=x>text</a>`` as ``[text](x)``; anchors without a target or an end stay."""
    def target(piece):
        inner = F.regexp_extract(piece, ANCHOR_PATTERN.replace("(?is)<a", "(?is)^<a"), 1)
        raw = F.regexp_extract(inner, HREF_PATTERN, 1)
        href = F.when(raw.startswith('"') | raw.startswith("'"), F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        rest = F.regexp_replace(piece, ANCHOR_PATTERN.replace("(?is)<a", "(?is)^<a"), "")
        ends = F.regexp_like(rest, F.lit(r"(?i)</a\s*>"))
        text = F.element_at(F.split(rest, r"(?i)</a\s*>", 2), 1)
        after = F.try_element_at(F.split(rest, r"(?i)</a\s*>", 2), F.lit(2))
        return F.when((href != "") & ends, F.concat(F.lit("["), F.trim(text), F.lit("]("), href, F.lit(")"), after)).otherwise(piece)

    parts = F.split(t, r"(?i)(?=<a[\s/])")
    return _let(t, lambda x: F.when(F.regexp_like(x, F.lit(r"(?i)<a[\s/]")), F.array_join(F.transform(parts, target), "")).otherwise(x))


def _keep_lines(html: Column) -> Column:
    """Line breaks inside ``<pre>`` as PRE_BREAK (code is not running text)."""
    def held(t):
        parts = F.split(t, r"(?i)(?=<pre\b)|(?=</pre\b)")
        lines = F.transform(parts, lambda x: F.when(
            F.regexp_like(x, F.lit(r"(?i)^<pre\b")), F.regexp_replace(F.regexp_replace(x, r"(?i)</?code\b[^>]*>", ""), r"\r\n?|\n", PRE_BREAK)).otherwise(x))
        return F.when(F.regexp_like(t, F.lit(r"(?i)<pre\b")), F.array_join(lines, "")).otherwise(t)

    return _let(html, held)


def finish_markdown(text) -> Column:
    """Drop the blanks that start lines (not those of preformatted lines), normalize, then indent nested list items."""
    t = normalize(F.translate(F.regexp_replace(_col(text), r"\n[ \t]+", "\n"), PRE_BREAK, "\n"))
    return F.replace(t, F.lit(INDENT), F.lit("  "))


def normalized_markdown(markdown) -> Column:
    """:func:`normalize` of markdown from :func:`finish_markdown`: only the indentation of nested items is not normal yet."""
    return _let(_col(markdown), lambda m: F.when(m.contains("\n  "), normalize(m)).otherwise(m))


def main_fragment(html) -> Column:
    """HTML from the first ``<article>``/``<main>`` to the end of the last one; else the body without furniture."""
    return main_fragment_from_code(strip_code(html))


def main_fragment_from_code(code_free) -> Column:
    """:func:`main_fragment` of a page whose comments/scripts/styles are already gone."""
    code_free = _col(code_free)
    art = F.regexp_extract(code_free, r"(?is)<(?:article|main)\b[^>]*>(.*)</(?:article|main)", 1)
    body = F.regexp_extract(code_free, r"(?is)<body\b[^>]*>(.*?)(?:</body|\z)", 1)
    body = F.when(body == "", code_free).otherwise(body)
    return F.when(art != "", art).otherwise(strip_boilerplate(body))


def page_markdown(html) -> Column:
    """Main content as markdown; '' when the page has none."""
    return fragment_to_markdown(main_fragment(html))


def attributes(inside: Column) -> Column:
    """The attributes of a start tag (the text after its name) as ``map<name, value>``.

    Names in lower case, values without quotes and with references decoded
    (empty without ``=``); of equal names the first counts, as in HTML.
    """
    def pair(piece):
        name = F.lower(F.regexp_extract(piece, r"^[^\s=]+", 0))
        raw = F.regexp_extract(piece, r"(?s)^[^\s=]+\s*=\s*(.*)$", 1)
        quoted = raw.startswith('"') | raw.startswith("'")
        value = F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        return F.struct(name.alias("name"), decode_entities(value).alias("value"))

    pairs = F.transform(F.regexp_extract_all(inside, F.lit(rf"(?s){_ATTRIBUTE}"), 0), pair)
    first = _let(pairs, lambda p: F.filter(p, lambda x, i: F.array_position(F.transform(p, lambda y: y["name"]), x["name"]) == i + 1))
    return F.map_from_entries(first)


# Names of meta tags that give a title, in order of preference after og:title.
TITLE_NAMES = ("title", "dc.title", "twitter:title")


def meta_title(html) -> Column:
    """Title of the page's metadata: ``og:title``, then a meta tag of a title's name, then a JSON-LD headline; '' without any."""
    html = _col(html)
    uncommented = lambda t: F.regexp_replace(t, r"(?s)<!--.*?-->", "")
    # meta tags stand before the body
    head = F.element_at(F.split(html, r"(?i)<body\b", 2), 1)
    tags = F.transform(F.regexp_extract_all(uncommented(head), F.lit(META_PATTERN), 1), attributes)

    def content(tag):
        return F.coalesce(strip_ws(tag["content"]), F.lit(""))

    def first(tags, key, name):
        return F.get(F.filter(F.transform(F.filter(tags, lambda a: F.lower(strip_ws(a[key])) == name), content), lambda c: c != ""), F.lit(0))

    def chosen(m):
        return F.coalesce(first(m, "property", "og:title"), *[first(m, "name", n) for n in TITLE_NAMES])

    scripts = F.regexp_extract_all(uncommented(html), F.lit(r"""(?si)<script\b[^>]*\bapplication/ld\+json\b[^>]*>(.*?)</script"""), 1)
    heads = F.transform(scripts, lambda j: strip_ws(F.coalesce(F.get_json_object(j, "$.headline"), F.get_json_object(j, "$[0].headline"), F.lit(""))))
    headline = F.get(F.filter(heads, lambda h: h != ""), F.lit(0))
    # "title" as something else than the title tag
    named = F.when(F.regexp_like(head, F.lit(r"(?i)(?<![</])title")) & F.regexp_like(head, F.lit(r"(?i)<meta\b")), _let(tags, chosen))
    told = F.when(html.contains("ld+json"), headline)
    return F.coalesce(named, told, F.lit(""))


def first_h1(markdown) -> Column:
    """Text of the first ``# `` heading (the whitespace after ``#`` may span lines)."""
    return strip_ws(F.regexp_extract(_col(markdown), rf"(?:\A|\n)#[{WS}]+([^\n]+)", 1))


def title_tag(html) -> Column:
    """``<title>`` text with whitespace runs collapsed (entities stay encoded)."""
    t = F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return strip_ws(F.regexp_replace(t, rf"[{WS}]+", " "))


def page_title(html, markdown) -> Column:
    """Metadata title, else first ``#`` heading, else ``<title>``, else ''."""
    return F.coalesce(
        F.nullif(meta_title(html), F.lit("")),
        F.nullif(first_h1(markdown), F.lit("")),
        F.nullif(title_tag(html), F.lit("")),
        F.lit(""),
    )


# Attributes of a start tag, quoted values as units (a value may hold ``>`` or look like an attribute).
_ATTRIBUTE = r"""[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
META_PATTERN = rf"(?is)<meta(?=[\s/])((?:[\s/]++|{_ATTRIBUTE})*+)>"
ANCHOR_PATTERN = rf"(?is)<a(?=[\s/])((?:[\s/]++|{_ATTRIBUTE})*+)>"
HREF_PATTERN = rf"""(?is)^(?:[\s/]++|(?!href[\s=/]){_ATTRIBUTE})*+href\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)"""


def hrefs(html) -> Column:
    """Every ``<a href>`` value in document order, references decoded (code blocks and comments skipped)."""
    tags = F.regexp_extract_all(strip_code(html), F.lit(ANCHOR_PATTERN), 1)
    raw = F.transform(tags, lambda a: F.regexp_extract(a, HREF_PATTERN, 1))
    unquoted = F.transform(raw, lambda v: F.when(
        v.startswith('"') | v.startswith("'"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    return F.filter(F.transform(unquoted, decode_entities), lambda v: v != "")
