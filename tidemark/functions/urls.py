"""URL column functions: netloc/path split, fragments, resolution.

All are regex or array expressions evaluated in the JVM.  They follow the
behaviour of Python's ``urllib.parse`` on the URL forms a crawl produces
(absolute http(s) URLs and the hrefs found in their pages).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme and authority of an absolute URL (RFC 3986 scheme syntax).
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_NETLOC_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_PATH_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(url) -> Column:
    """Authority part (``host[:port]``), '' when the URL has none."""
    return F.regexp_extract(_col(url), _NETLOC_PATTERN, 1)


def url_path(url) -> Column:
    """Path without query, fragment and the ``;params`` of the last segment."""
    p = F.regexp_extract(_col(url), _PATH_PATTERN, 1)
    return F.regexp_replace(p, r";[^/]*\z", "")


def url_path_and_query(url) -> Column:
    """Path plus ``?query`` (what robots rules are matched against), '/' if empty."""
    u = defrag(url)
    pq = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return F.when(pq == "", F.lit("/")).otherwise(
        F.when(pq.startswith("?"), F.concat(F.lit("/"), pq)).otherwise(pq))


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def defrag(url) -> Column:
    """Drop the ``#fragment``."""
    return F.regexp_replace(_col(url), r"#.*\z", "")


def chunk_id_base(url) -> Column:
    """``netloc + path`` of a page URL (scheme, query and fragment ignored)."""
    return F.concat(netloc(url), url_path(url))


def site_start_url(url) -> Column:
    """``https://<host>/`` for a page URL: the key of the site the page belongs to."""
    return F.concat(F.lit("https://"), netloc(url), F.lit("/"))


def _remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 over the ``/``-separated segments of an absolute path.

    Folds the segment array into a stack: ``..`` pops, ``.`` is skipped.  A
    trailing ``.`` or ``..`` leaves a trailing slash, as in ``urljoin``.
    """
    segs = F.slice(F.split(path, "/", -1), 2, 1 << 30)
    n = F.size(segs)
    folded = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segs, n)
    trail = F.when((n > 0) & last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.size(folded) == 0, F.lit("/")).otherwise(F.concat(F.lit("/"), F.array_join(folded, "/"), trail))


def resolve(base, href) -> Column:
    """``urljoin(base, href)`` for http(s) bases.

    Cases: absolute href (own scheme) as is, with the scheme lower-cased when
    it equals the base's; ``//host`` takes the base scheme; ``/path`` takes
    the base authority; ``?q`` keeps the base path; ``#f`` keeps the base
    path and query; anything else merges with the base directory.  Dot
    segments are removed, and for merged relative paths empty inner
    segments are dropped as Python does.
    """
    b, h = _col(base), _col(href)
    h = F.regexp_replace(h, r"[\t\n\r]", "")
    h = F.regexp_replace(h, r"\A[\x00-\x20]+", "")
    b_scheme = scheme(b)
    b_auth = F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1),
                      F.lit("//"), netloc(b))
    b_path = F.regexp_extract(b, _PATH_PATTERN, 1)
    b_query = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)?", 1)
    h_scheme = scheme(h)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_extract(h, r"^[^?#]*(.*)\z", 1)
    b_dir = F.regexp_replace(b_path, r"[^/]*\z", "")
    merged = F.concat(F.when(b_dir == "", F.lit("/")).otherwise(b_dir), h_path)
    merged = F.regexp_replace(merged, r"/{2,}", "/")
    absolute_path = F.concat(b_auth, _remove_dot_segments(h_path), h_rest)
    with_scheme = F.when(
        h_scheme == b_scheme,
        F.concat(b_scheme, F.regexp_replace(h, r"^[A-Za-z][A-Za-z0-9+.\-]*", "")),
    ).otherwise(h)
    return (
        F.when(h == "", b)
        .when((h_scheme != "") & h.rlike(_SCHEME), with_scheme)
        .when(h.startswith("//"), F.concat(b_scheme, F.lit(":"), h))
        .when(h.startswith("/"), absolute_path)
        .when(h.startswith("?"), F.concat(b_auth, b_path, h))
        .when(h.startswith("#"), F.concat(b_auth, b_path, b_query, h))
        .otherwise(F.concat(b_auth, _remove_dot_segments(merged), h_rest))
    )
