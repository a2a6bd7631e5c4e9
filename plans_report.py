"""Print the physical plans (operator trees) of the headline operators as markdown.

Usage: python plans_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import chunk as C
from tidemark.operators import diff as D
from tidemark.operators import discover as X
from tidemark.operators import extract as E
from tidemark.operators import render as R
from tidemark.plans import inputs as I
from tidemark.session import build_session
from tidemark.sources import discovery as SD


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def _clean(text: str, limit: int = 150) -> str:
    text = " ".join(str(text).split())
    return text if len(text) <= limit else text[:limit] + " ..."


def _label(node) -> str:
    name = node.nodeName()
    try:
        if "Exchange" in name:
            return f"{name} {_clean(node.outputPartitioning().toString())}"
        if name in ("Window", "WindowGroupLimit"):
            spec = _clean(node.partitionSpec().mkString(", "))
            mode = f" {node.mode()}" if name == "WindowGroupLimit" else ""
            return f"{name} partition by [{spec}]{mode}"
        if "Aggregate" in name:
            return f"{name} keys [{_clean(node.groupingExpressions().mkString(', '))}]"
        if "Join" in name:
            return f"{name} {node.joinType()} on [{_clean(node.leftKeys().mkString(', '))}]"
        if "Scan" in name and hasattr(node, "metadata"):
            md = node.metadata()
            loc = md.get("Location").get() if md.contains("Location") else ""
            table = loc.rsplit("/", 1)[-1].rstrip("]")
            parts = [f"{k}={_clean(md.get(k).get(), 120)}" for k in ("PushedFilters", "ReadSchema") if md.contains(k)]
            return f"{name} {table} " + " ".join(parts)
    except Exception:  # noqa: BLE001 - a node without the expected fields prints its name only
        pass
    return name


def short(df) -> str:
    lines = []

    def walk(node, depth):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.initialPlan(), depth)
        if name in ("WholeStageCodegen", "InputAdapter") or name.startswith("WholeStageCodegen"):
            for c in _seq(node.children()):
                walk(c, depth)
            return
        lines.append("  " * depth + _label(node))
        for c in _seq(node.children()):
            walk(c, depth + 1)

    walk(df._jdf.queryExecution().executedPlan(), 0)
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    raw = I.raw_pages(spark, sf, "cur")
    prev = C.chunk_pages(E.extract_pages(E.pages_ok(I.raw_pages(spark, sf, "prev"))))
    cur = C.chunk_pages(E.extract_pages(E.pages_ok(raw)))
    tmp = tempfile.mkdtemp(prefix="tidemark-plans-")
    prev.write.parquet(os.path.join(tmp, "p"))
    cur.write.parquet(os.path.join(tmp, "c"))
    sp, sc = spark.read.parquet(os.path.join(tmp, "p")), spark.read.parquet(os.path.join(tmp, "c"))
    store = X._LevelStore(spark)
    sites = store.put(X.site_globs(I.crawl_sites(spark, sf)).withColumn("respect_robots", F.lit(True)), "sites")
    targets = I.crawl_pages(spark, sf).select("start_url", "url")
    rules = SD.robots_rules(I.crawl_robots(spark, sf), I.CRAWL_AGENT)
    cases = [
        ("extract + non-blank filter", E.pipeline_pages(raw)),
        ("chunk pages", C.chunk_pages(I.conversation_pages(spark, sf))),
        ("diff of two computed snapshots", D.diff_chunks(prev, cur)),
        ("diff of two stored snapshots (narrow first)", D.diff_snapshots(sp, sc)),
        ("ledger diff (600k chunks at sf0.1)", D.diff_chunks(I.ledger_chunks(spark, sf, "prev"),
                                                               I.ledger_chunks(spark, sf, "cur"))),
        ("full text records", R.llms_full(E.pipeline_pages(raw))),
        ("comparison of two runs by id", D.run_id_set_diff(sp, sc)),
        ("audit of a change table", D.change_audit(D.diff_snapshots(sp, sc), sp, sc)),
        ("what the walk may fetch: globs, robots rules, responses", X._fetchable(targets, I.crawl_responses(spark, sf), sites, rules)),
    ]
    print("# Physical plans of the headline operators\n")
    print(f"Generated by `python plans_report.py {sf}` (Spark {spark.version}, AQE on; "
          "initial plans, before runtime re-optimization). Expression details are cut.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{short(df)}\n```\n")


if __name__ == "__main__":
    main()
