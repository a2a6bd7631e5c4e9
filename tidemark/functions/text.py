"""Text rules shared by extraction, chunking and the diff (Column -> Column).

Every function here returns a JVM-side expression, so it stays inside
whole-stage codegen; nothing is evaluated in Python.

Whitespace follows Python's ``str.isspace`` set, which is what the tracked
hashes were defined over.  Java's ``\\s`` and Spark's ``trim`` cover a smaller
set, so the class is spelled out.  The same pattern text is valid in Java
regex and in RE2 (DuckDB), which the SQL oracles rely on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters for which Python's str.isspace() is true,
# as a character class body (Java regex and RE2 accept the same text).
WS = (
    r"\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same set without the newline (line-internal whitespace).
WSNL = (
    r"\t\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Fixed value: prefix stored in front of every SHA-256 hex digest.
HASH_PREFIX = "sha256:"

# Fixed value: ATX heading line, 1-6 hashes, whitespace, text ending in a
# non-blank character.  Group 1 is the marker, group 2 the heading text.
HEADING_PATTERN = rf"(?s)\A(#{{1,6}})[{WS}]++(.*[^{WS}])[{WS}]*\z"


# Leading or trailing whitespace.  The look-behind makes a run start only at
# its first character, so long inner runs are scanned once (linear time).
_STRIP = rf"\A[{WS}]++|(?<![{WS}])[{WS}]++\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c) -> Column:
    """Canonical form of a text before hashing.

    Line endings become ``\\n``; runs of spaces/tabs become one space; each
    line loses trailing whitespace; two or more blank lines become one; the
    whole text loses leading and trailing whitespace.  Idempotent.
    """
    t = F.regexp_replace(_col(c), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, rf"(?<![{WSNL}])[{WSNL}]++(?=\n|\z)", "")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.regexp_replace(t, _STRIP, "")


def strip_ws(c) -> Column:
    """Python ``str.strip()`` (Unicode whitespace at both ends)."""
    return F.regexp_replace(_col(c), _STRIP, "")


def sha256_hex(c) -> Column:
    """``sha256:`` + hex digest of the UTF-8 bytes of an already normal text."""
    return F.concat(F.lit(HASH_PREFIX), F.sha2(_col(c), 256))


def text_hash(c) -> Column:
    """``sha256:`` + hex digest of the normalized text."""
    return sha256_hex(normalize(c))


def token_estimate(c) -> Column:
    """Whitespace word count (the number of maximal non-blank runs)."""
    return F.size(F.regexp_extract_all(_col(c), F.lit(rf"[^{WS}]+"), 0)).cast("int")


def slug(c) -> Column:
    """Lower-case, runs outside ``[a-z0-9]`` to ``-``, trim ``-``; empty -> ``section``."""
    s = F.regexp_replace(F.lower(strip_ws(c)), r"[^a-z0-9]+", "-")
    s = F.regexp_replace(s, r"\A-+|-+\z", "")
    return F.when(s == "", F.lit("section")).otherwise(s)


def heading_level(line) -> Column:
    """0 for a body line, else the ATX heading level (1-6)."""
    return F.length(F.regexp_extract(_col(line), HEADING_PATTERN, 1))


def heading_text(line) -> Column:
    """Heading text of an ATX heading line ('' for body lines)."""
    return F.regexp_extract(_col(line), HEADING_PATTERN, 2)
