"""DuckDB SQL text for the column rules, used by the independent oracles.

Each builder takes SQL expression text and returns SQL expression text with
the same meaning as the Spark function of the same name.  RE2 has no
look-around and no possessive quantifiers, so a few rules are restated
(e.g. right-stripping lines consumes the newline and puts it back).
"""

from __future__ import annotations

NL = "chr(10)"

# Stated here again, in RE2's terms and for the markup that the test pages hold.
WS = r"\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WSNL = WS.replace(r"\n", "", 1)
BLOCK = "article|section|main|div|p|ul|ol|dl|dt|dd|nav|header|footer|aside|table|t(?:head|body|foot)|blockquote|pre|fig(?:ure|caption)|form|hr|address|details|summary"


def lit(s: str) -> str:
    """SQL string literal; newlines become ``chr(10)`` so the text stays one line."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    out = f" || {NL} || ".join(quoted)
    return f"({out})" if len(parts) > 1 else out


def rr(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(repl)}, 'g')"


def rx(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {lit(pattern)}, {group})"


def strip_ws(x: str) -> str:
    return rr(x, rf"\A[{WS}]+|[{WS}]+\z")


def normalize(x: str) -> str:
    t = rr(x, r"\r\n?", "\n")
    t = rr(t, r"[ \t]+", " ")
    t = rr(t, rf"[{WSNL}]+\n", "\n")
    t = rr(t, rf"[{WSNL}]+\z")
    t = rr(t, r"\n{3,}", "\n\n")
    return strip_ws(t)


def sha256_hex(x: str) -> str:
    return f"('sha256:' || sha256({x}))"


def text_hash(x: str) -> str:
    return sha256_hex(normalize(x))


def token_estimate(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {lit(f'[^{WS}]+')})) AS INTEGER)"


def slug(x: str) -> str:
    s = rr(f"lower({strip_ws(x)})", r"[^a-z0-9]+", "-")
    s = rr(s, r"\A-+|-+\z")
    return f"(CASE WHEN {s} = '' THEN 'section' ELSE {s} END)"


HEADING = rf"(?s)\A(#{{1,6}})[{WS}]+(.*[^{WS}])[{WS}]*\z"


def heading_level(x: str) -> str:
    return f"length({rx(x, HEADING, 1)})"


def heading_text(x: str) -> str:
    return rx(x, HEADING, 2)


# --- URLs -------------------------------------------------------------------

def netloc(x: str) -> str:
    return rx(x, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def url_path(x: str) -> str:
    return rr(rx(x, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), r";[^/]*\z")


def chunk_id_base(x: str) -> str:
    return f"({netloc(x)} || {url_path(x)})"


def site_start_url(x: str) -> str:
    return f"('https://' || {netloc(x)} || '/')"


def defrag(x: str) -> str:
    return rr(x, r"(?s)#.*\z")


# --- HTML -------------------------------------------------------------------

def _drop_block(x: str, tag: str) -> str:
    return rr(x, rf"(?is)<{tag}\b.*?</{tag}[^>]*>")


def strip_code(x: str) -> str:
    t = rr(x, r"(?s)<!--.*?-->")
    return _drop_block(_drop_block(t, "style"), "script")


def strip_boilerplate(x: str) -> str:
    for tag in ("aside", "footer", "header", "nav"):
        x = _drop_block(x, tag)
    return x


def decode_entities(x: str) -> str:
    """The references that the test pages hold."""
    t = x
    for name, ch in (("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = f"replace({t}, {lit(name)}, {lit(ch)})"
    return t


def fragment_to_markdown(x: str, links: bool = False) -> str:
    """For the markup of the test pages: flat lists, no tables; with ``links`` anchors show their targets."""
    t = rr(x, r"[ \t\n\r\f]+", " ")
    if links:
        t = rr(t, r"""(?i)<a\b[^>]*\bhref="([^"]+)"[^>]*>([^<]*)</a>""", r"[\2](\1)")
    for level in range(1, 7):
        t = rr(t, rf"(?i)<h{level}\b[^>]*>", "\n\n" + "#" * level + " ")
    t = rr(t, r"(?i)</h[1-6]\s*>", "\n\n")
    t = rr(t, r"(?i)<br\b[^>]*>", "\n")
    t = rr(t, r"(?i)<li\b[^>]*>", "\n- ")
    t = rr(t, r"(?i)</t[dh]\s*>", " ")
    t = rr(t, r"(?i)</?tr\b[^>]*>", "\n")
    t = rr(t, rf"(?i)</?(?:{BLOCK})\b[^>]*>", "\n\n")
    t = rr(t, r"</?[A-Za-z!][^>]*>")
    t = decode_entities(t)
    t = rr(t, r"\n[ \t]+", "\n")
    return normalize(t)


def main_fragment_from_code(code: str) -> str:
    art = rx(code, r"(?is)<(?:article|main)\b[^>]*>(.*)</(?:article|main)", 1)
    body = rx(code, r"(?is)<body\b[^>]*>(.*?)(?:</body|\z)", 1)
    body = f"(CASE WHEN {body} = '' THEN {code} ELSE {body} END)"
    return f"(CASE WHEN {art} <> '' THEN {art} ELSE {strip_boilerplate(body)} END)"


def og_title(html: str) -> str:
    return strip_ws(rx(html, r"""(?is)<meta\b[^>]*\bproperty\s*=\s*["']og:title["'][^>]*\bcontent\s*=\s*["]([^"]*)["]""", 1))


def first_h1(md: str) -> str:
    return strip_ws(rx(md, rf"(?:\A|\n)#[{WS}]+([^\n]+)", 1))


def title_tag(html: str) -> str:
    t = rx(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return strip_ws(rr(t, rf"[{WS}]+", " "))


def page_title(html: str, md: str) -> str:
    return (f"coalesce(nullif({og_title(html)}, ''), nullif({first_h1(md)}, ''), "
            f"nullif({title_tag(html)}, ''), '')")


def hrefs(html: str) -> str:
    # the test pages write href first and in double quotes
    raw = f"regexp_extract_all({strip_code(html)}, {lit('(?i)<a href=' + chr(34) + '([^' + chr(34) + ']*)')}, 1)"
    dec = f"list_transform({raw}, lambda v: replace(v, '&amp;', '&'))"
    return f"list_filter({dec}, lambda v: v <> '')"


def scheme(x: str) -> str:
    return f"lower({rx(x, r'^([A-Za-z][A-Za-z0-9+.\-]*):', 1)})"


def url_path_and_query(x: str) -> str:
    pq = rx(defrag(x), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return f"(CASE WHEN {pq} = '' THEN '/' WHEN starts_with({pq}, '?') THEN '/' || {pq} ELSE {pq} END)"


def resolve(b: str, h0: str) -> str:
    """``urljoin`` for http(s) bases; dot segments are not removed (the test hrefs have none)."""
    h = rr(rr(h0, r"[\t\n\r]"), r"\A[\x00-\x20]+")
    b_auth = f"({rx(b, r'^([A-Za-z][A-Za-z0-9+.\-]*:)', 1)} || '//' || {netloc(b)})"
    b_path = rx(b, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    b_query = rx(b, r"^[^?#]*(\?[^#]*)?", 1)
    h_path = rx(h, r"^([^?#]*)", 1)
    h_rest = rx(h, r"(?s)^[^?#]*(.*)\z", 1)
    b_dir = rr(b_path, r"[^/]*\z")
    merged = rr(f"(CASE WHEN {b_dir} = '' THEN '/' ELSE {b_dir} END || {h_path})", r"/{2,}", "/")
    with_scheme = (f"(CASE WHEN {scheme(h)} = {scheme(b)} THEN {scheme(b)} || "
                   f"{rr(h, r'^[A-Za-z][A-Za-z0-9+.\-]*')} ELSE {h} END)")
    return (f"(CASE WHEN {h} = '' THEN {b} "
            f"WHEN {scheme(h)} <> '' AND regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {with_scheme} "
            f"WHEN starts_with({h}, '//') THEN {scheme(b)} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {b_auth} || {h_path} || {h_rest} "
            f"WHEN starts_with({h}, '?') THEN {b_auth} || {b_path} || {h} "
            f"WHEN starts_with({h}, '#') THEN {b_auth} || {b_path} || {b_query} || {h} "
            f"ELSE {b_auth} || {merged} || {h_rest} END)")


def glob_regex(g: str) -> str:
    t = f"regexp_replace({g}, '([.^$+{{}}()|\\\\])', '\\\\\\1', 'g')"
    t = f"replace(replace(replace({t}, '*', '.*'), '?', '.'), '[!', '[^')"
    return f"('(?s)' || {t})"


def glob_ok(path: str, include: str, exclude: str) -> str:
    ex = f"coalesce(list_bool_or(list_transform({exclude}, lambda g: regexp_full_match({path}, {glob_regex('g')}))), false)"
    inc = (f"(CASE WHEN coalesce(len({include}), 0) = 0 THEN true ELSE "
           f"list_bool_or(list_transform({include}, lambda g: regexp_full_match({path}, {glob_regex('g')}))) END)")
    return f"(NOT {ex} AND {inc})"
