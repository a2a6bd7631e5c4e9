"""Discovery inputs given as text tables: sitemaps and robots files.

A sitemap is parsed document by document with the standard XML parser.  A
robots file, parsed with column expressions, is one row per
host; its lines are exploded and grouped with a window over that host's
lines only (a robots file is one small document, so the window's partition
is bounded by the file, not by the crawl).
"""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws

# Fixed value: line breaks recognised when a text is split into lines.
LINE_BREAKS = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def _locations(xml: str | None) -> list[str]:
    """Texts of the elements whose tag ends in ``loc``, in document order; nothing from a document that is not XML."""
    try:
        root = ElementTree.fromstring((xml or "").strip())
    except ElementTree.ParseError:
        return []
    return [e.text for e in root.iter() if isinstance(e.tag, str) and e.tag.endswith("loc") and e.text]


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """``sitemaps(host, xml, [part])`` -> ``host, part, pos, url`` in document order.

    Every element whose tag ends in ``loc`` contributes its text (references
    and CDATA resolved, whitespace stripped); an element without text, a
    comment and a document that does not parse contribute nothing.
    """
    @F.pandas_udf("array<string>")
    def locations(xml: pd.Series) -> pd.Series:
        return xml.map(_locations)

    part = F.col("part") if "part" in sitemaps.columns else F.lit(0).cast("long")
    locs = sitemaps.select("host", part.alias("part"), F.posexplode(locations("xml")).alias("pos", "raw"))
    return locs.select("host", "part", "pos", strip_ws("raw").alias("url"))


def _unquote(c):
    """Percent-decoding that leaves ``+`` and malformed escapes as they are."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def robots_lines(robots: DataFrame) -> DataFrame:
    """``host, ln, kind, value`` for the lines that matter: blank, ua, allow, disallow, other."""
    lines = robots.select("host", F.posexplode(F.split("text", LINE_BREAKS, -1)).alias("ln", "raw"))
    body = strip_ws(F.regexp_replace("raw", r"#.*", ""))
    key = F.lower(strip_ws(F.regexp_extract(body, r"^([^:]*):", 1)))
    value = _unquote(strip_ws(F.regexp_extract(body, r"(?s)^[^:]*:(.*)$", 1)))
    has_colon = body.contains(":")
    kind = (F.when(F.col("raw") == "", F.lit("blank"))
            .when(~has_colon, F.lit(None))
            .when(key == "user-agent", F.lit("ua"))
            .when(key == "allow", F.lit("allow"))
            .when(key == "disallow", F.lit("disallow"))
            .when(key.isin("crawl-delay", "request-rate"), F.lit("other")))
    return lines.select("host", "ln", kind.alias("kind"), value.alias("value")).where(F.col("kind").isNotNull())


def robots_rules(robots: DataFrame, agent: str = "tidemark") -> DataFrame:
    """The rules that apply to ``agent`` on each host: ``host, seq, allow, path``.

    Groups: a blank line, or a user-agent line that follows a rule, starts a
    new group; a group counts only with agents and rule lines.  The group for
    the agent is the first one naming a substring of the agent token, else
    the first ``*`` group.  An empty ``Disallow:`` allows everything.
    """
    token = agent.split("/")[0].lower()
    ln = robots_lines(robots)
    w = Window.partitionBy("host").orderBy("ln")
    state_kind = F.when(F.col("kind") != "blank", F.col("kind"))
    prev_kind = F.last(state_kind, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = (F.col("kind") == "blank") | ((F.col("kind") == "ua") & F.coalesce(prev_kind != "ua", F.lit(False)))
    g = ln.select("*", F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("grp"))
    groups = g.groupBy("host", "grp").agg(
        F.count_if(F.col("kind") == "ua").alias("n_agents"),
        F.count_if(F.col("kind").isin("allow", "disallow", "other")).alias("n_rules"),
        F.max((F.col("kind") == "ua") & (F.col("value") == "*")).alias("has_star"),
        F.max((F.col("kind") == "ua") & (F.col("value") != "*")
              & F.lit(token).contains(F.lower(F.col("value")))).alias("names_us"),
    )
    chosen = (groups.where((F.col("n_agents") > 0) & (F.col("n_rules") > 0) & (F.col("has_star") | F.col("names_us")))
                    .groupBy("host").agg(F.min(F.struct("has_star", "grp")).alias("_c"))
                    .select("host", F.col("_c.grp").alias("grp")))
    rules = g.where(F.col("kind").isin("allow", "disallow")).join(chosen, ["host", "grp"], "left_semi")
    return rules.select("host", F.col("ln").alias("seq"),
                        ((F.col("kind") == "allow") | (F.col("value") == "")).alias("allow"),
                        F.col("value").alias("path"))
