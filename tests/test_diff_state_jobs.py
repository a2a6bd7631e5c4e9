"""Changes between two days, first run, duplicates, state round trip, a shop over three runs, jobs end to end."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.contract import CHUNK, ContractError, assert_schema, contract_violations, record_violations
from tidemark.operators import diff as D
from tidemark.operators import order as O
from tidemark.plans.jobs import run_diff_job
from tidemark.sources import state as S

COLS = "start_url string, page_seq long, chunk_id string, url string, heading_path array<string>, text string, " \
       "token_estimate int, chunk_hash string, order int"


def chunks(spark, items, site="https://boats.example.org/"):
    """One chunk per (name, text): rows in crawl order, hashes of the texts."""
    rows = [(site, n, f"boats.example.org/{name}", site + name, ["Fleet", name], text, len(text.split()),
             "sha256:" + hashlib.sha256(text.encode()).hexdigest(), 0) for n, (name, text) in enumerate(items)]
    return spark.createDataFrame(rows, COLS)


MONDAY = [("ketch", "two masts"), ("sloop", "one mast"), ("raft", "no mast"), ("punt", "flat and slow")]
TUESDAY = [("sloop", "one tall mast"), ("ketch", "two masts"), ("yawl", "two masts, small mizzen"), ("punt", "flat and slow")]


def test_changes_between_two_days(spark):
    prev, cur = chunks(spark, MONDAY), chunks(spark, TUESDAY)
    got = {r.chunk_id.split("/")[1]: (r.change_type, r.text) for r in D.diff_chunks(prev, cur).collect()}
    assert got == {"sloop": ("modified", "one tall mast"), "yawl": ("added", "two masts, small mizzen"), "raft": ("removed", "no mast")}
    sites = spark.createDataFrame([("https://boats.example.org/",), ("https://idle.example.org/",)], "start_url string")
    summary = {r.start_url: (r.added, r.modified, r.removed) for r in D.change_summary(D.diff_chunks(prev, cur), sites).collect()}
    assert summary == {"https://boats.example.org/": (1, 1, 1), "https://idle.example.org/": (0, 0, 0)}


def test_change_order(spark):
    rows = O.diff_ordered(D.diff_chunks(chunks(spark, MONDAY), chunks(spark, TUESDAY))).orderBy("seq").collect()
    assert [(r.seq, r.chunk_id.split("/")[1]) for r in rows] == [(1, "sloop"), (2, "yawl"), (3, "raft")]


def test_first_run_and_unchanged_rerun(spark):
    cur = chunks(spark, TUESDAY)
    assert [r.change_type for r in D.diff_chunks(None, cur).collect()] == ["added"] * 4
    assert D.diff_chunks(cur, cur).count() == 0


def test_last_row_wins_first_position(spark):
    cur = chunks(spark, [("sloop", "old"), ("raft", "logs"), ("sloop", "new")])
    lw = {r.chunk_id.split("/")[1]: (r.text, r.pos_seq) for r in D.last_wins(cur).collect()}
    assert lw == {"sloop": ("new", 0), "raft": ("logs", 1)}


def test_null_urls_and_paths_are_not_lost(spark):
    cur = chunks(spark, MONDAY).withColumns({"url": F.lit(None).cast("string"), "heading_path": F.lit(None).cast("array<string>")})
    assert D.diff_snapshots(None, cur).count() == 4


def test_two_sites_with_equal_ids_are_separate(spark):
    prev = chunks(spark, [("oar", "ash")], "https://one/").unionByName(chunks(spark, [("oar", "ash")], "https://two/"))
    cur = chunks(spark, [("oar", "ash")], "https://one/").unionByName(chunks(spark, [("oar", "pine")], "https://two/"))
    got = D.diff_chunks(prev, cur).collect()
    assert [(r.start_url, r.change_type) for r in got] == [("https://two/", "modified")]


def test_audit_and_set_diff(spark):
    prev, cur = chunks(spark, MONDAY), chunks(spark, TUESDAY)
    assert D.change_audit(D.diff_chunks(prev, cur), prev, cur).count() == 0
    sides = {(r.chunk_id.split("/")[1], r.side) for r in D.run_id_set_diff(prev, cur).collect()}
    assert sides == {("yawl", "only_current"), ("raft", "only_previous"), ("sloop", "hash_changed")}


def test_audit_finds_every_kind(spark):
    prev, cur = chunks(spark, MONDAY), chunks(spark, TUESDAY)
    right = D.diff_chunks(prev, cur)

    def found(**changed):
        spoilt = right
        for name, value in changed.items():
            kind, column = name.split("_of_")[1], name.split("_of_")[0]
            spoilt = spoilt.withColumn(column, F.when(F.col("chunk_id").endswith(kind), F.lit(value)).otherwise(F.col(column)))
        return sorted((r.chunk_id.split("/")[1], r.change_type) for r in D.change_audit(spoilt, prev, cur).collect())

    assert found() == []
    assert found(change_type_of_yawl="modified") == [("yawl", "modified")]          # not in the previous run
    assert found(change_type_of_raft="added") == [("raft", "added")]                # gone
    assert found(change_type_of_sloop="removed") == [("sloop", "removed")]          # still there
    assert found(chunk_hash_of_sloop="sha256:0") == [("sloop", "modified")]         # of neither run
    assert found(chunk_id_of_yawl="boats.example.org/nowhere") == [("nowhere", "added")]
    assert D.change_audit(right, None, cur).count() == 2                            # modified and removed need a previous run
    same = D.diff_chunks(prev, prev.limit(0)).withColumn("change_type", F.lit("modified"))
    assert D.change_audit(same, prev, prev).count() == 4                            # nothing changed


def test_records_of_a_contract(spark):
    good = '{"chunk_id":"a","url":"u","heading_path":["x"],"text":"t","token_estimate":1,"chunk_hash":"h","order":0}'
    lines = {"good": good, "empty path": good.replace('["x"]', "[]"), "text": good.replace('"order":0', '"order":"0"'), "null": good.replace('"t"', "null"),
             "gone": good.replace('"url":"u",', ""), "more": good.replace('"order"', '"Order":1,"order"'), "half": good[:-1], "list": "[1]", "none": None,
             "numbers": good.replace('["x"]', "[1]"), "fraction": good.replace('"token_estimate":1', '"token_estimate":1.5')}
    df = spark.createDataFrame(list(lines.items()), "name string, value string")
    got = {}
    for r in record_violations(df, CHUNK).collect():
        got.setdefault(r.name, []).append((r.field, r.rule))
    assert got == {"text": [("order", "type")], "null": [("text", "null")], "gone": [("url", "missing")], "more": [("Order", "unknown")], "half": [("", "not_json")],
                   "list": [("", "not_json")], "none": [("", "not_json")], "numbers": [("heading_path", "type")], "fraction": [("token_estimate", "type")]}


def test_contract(spark):
    c = chunks(spark, [("a", "1")]).drop("start_url", "page_seq")
    assert_schema(c, CHUNK)
    with pytest.raises(ContractError):
        assert_schema(c.withColumn("extra", F.lit(1)), CHUNK)
    bad = c.withColumn("order", F.lit(-1)).withColumn("chunk_hash", F.lit("md5:x"))
    rules = {r.rule for r in contract_violations(bad, CHUNK, "chunk_id").collect()}
    assert rules == {"order_non_negative", "chunk_hash_format"}
    assert '"heading_path"' in CHUNK.json()


def _ids(df):
    return {r.chunk_id.split("/")[1] for r in df.collect()}


def test_state_round_trip(spark, tmp_path):
    state = S.Snapshots(spark, str(tmp_path / "state"))
    c = chunks(spark, [("a", "1"), ("b", "2")])
    state.save(c, "2026-01-01T00:00:00Z")
    state.save(c.limit(1), "2026-01-02T00:00:00Z")
    latest = state.chunks(state.previous())
    assert _ids(latest) == {"a"} and latest.first().run_at == "2026-01-02T00:00:00Z"
    assert _ids(state.chunks(state.previous("2026-01-02T00:00:00Z"))) == {"a", "b"}
    unknown = spark.createDataFrame([("https://unknown/",)], "start_url string")
    assert state.chunks(state.previous(sites=unknown)).count() == 0
    key = spark.createDataFrame([("https://x/",)], "u string").select(S.state_key("u")).first()[0]
    assert len(key) == 16
    frames = S.load_latest(c.withColumn("run_at", F.lit("1")).union(c.limit(1).withColumn("run_at", F.lit("2"))))
    assert _ids(frames) == {"a"}


SHOP = "https://kites.example.org/"
SPRING = {
    "/": "<html><body><header>Kite shop</header><main><h1>Kites</h1><p>Open daily.</p></main></body></html>",
    "/delta": "<html><body><main><h1>Delta</h1><p>Flies in light wind.</p><h2>Line</h2><p>Sixty metres.</p></main></body></html>",
    "/box": "<html><body><main><h1>Box</h1><p>Needs a breeze.</p></main></body></html>",
}
SUMMER = {
    "/": "<html><body><header>Kite shop, summer</header><main><h1>Kites</h1>\n<p>Open   daily.</p></main></body></html>",
    "/delta": "<html><body><main><h1>Delta</h1><p>Flies in light wind.</p><h2>Line</h2><p>Eighty metres.</p></main></body></html>",
    "/sled": "<html><body><main><h1>Sled</h1><p>For children.</p></main></body></html>",
}


def _raw(spark, site, home=SHOP):
    rows = [(home, i, home[:-1] + p, html, 200, "2026-03-01T00:00:00Z", 0) for i, (p, html) in enumerate(site.items())]
    return spark.createDataFrame(rows, "start_url string, page_seq long, url string, raw_html string, status int, "
                                       "fetched_at string, depth int")


def test_a_shop_over_three_runs(spark):
    root = tempfile.mkdtemp(prefix="tidemark-job-")
    state = os.path.join(root, "state")
    h1 = run_diff_job(spark, _raw(spark, SPRING), state, os.path.join(root, "r1"), "2026-03-01").first()
    assert h1.prev_run_at is None and (h1.summary.added, h1.summary.removed) == (4, 0)
    h2 = run_diff_job(spark, _raw(spark, SUMMER), state, os.path.join(root, "r2"), "2026-06-01").first()
    assert h2.prev_run_at == "2026-03-01"                       # run marks stay text, whatever they look like
    ch = {r.chunk_id: r.change_type for r in spark.read.json(os.path.join(root, "r2", "changeset_changes")).collect()}
    assert ch == {"kites.example.org/sled#sled": "added", "kites.example.org/box#box": "removed",
                  "kites.example.org/delta#delta.line": "modified"}
    assert (h2.summary.added, h2.summary.modified, h2.summary.removed) == (1, 1, 1)
    h3 = run_diff_job(spark, _raw(spark, SUMMER), state, os.path.join(root, "r3"), "2026-09-01").first()
    assert (h3.summary.added, h3.summary.modified, h3.summary.removed, h3.prev_run_at) == (0, 0, 0, "2026-06-01")
    # a retried run replaces its own state partition
    run_diff_job(spark, _raw(spark, SUMMER), state, os.path.join(root, "r3b"), "2026-09-01")
    saved = S.Snapshots(spark, state)
    assert saved.chunks(saved.runs.manifest(run_at="2026-09-01")).count() == 4
    idx = _site_text(os.path.join(root, "r2", "site_index_txt"))
    assert idx.startswith("# kites.example.org\n\n> ") and idx.endswith(
        "## Pages\n- [Kites](https://kites.example.org/)\n- [Delta](https://kites.example.org/delta)\n"
        "- [Sled](https://kites.example.org/sled)\n")
    full = _site_text(os.path.join(root, "r2", "site_full_txt"))
    assert full.startswith("# Kites\n<https://kites.example.org/>\n\n# Kites\n\nOpen daily.\n\n---\n\n# Delta")
    assert full.count("\n---\n\n") == 2 and full.endswith("For children.\n\n")


def test_a_run_touches_its_own_sites_only(spark):
    root = tempfile.mkdtemp(prefix="tidemark-scope-")
    state, other = os.path.join(root, "state"), "https://lamps.example.org/"
    both = _raw(spark, SPRING).unionByName(_raw(spark, {"/": "<main><h1>Lamps</h1><p>Oil.</p></main>"}, other))
    run_diff_job(spark, both, state, os.path.join(root, "r1"), "0001")
    header = run_diff_job(spark, _raw(spark, SUMMER), state, os.path.join(root, "r2"), "0002").collect()
    assert [(r.start_url, r.prev_run_at, r.summary.removed) for r in header] == [(SHOP, "0001", 1)]
    changes = spark.read.json(os.path.join(root, "r2", "changeset_changes")).collect()
    assert {r.start_url for r in changes} == {SHOP}
    # a listed site without pages gives removals, against its own latest run
    sites = spark.createDataFrame([(other,)], "start_url string")
    gone = run_diff_job(spark, _raw(spark, SPRING, other).limit(0), state, os.path.join(root, "r3"), "0003", sites).collect()
    assert [(r.start_url, r.prev_run_at, r.summary.removed) for r in gone] == [(other, "0001", 1)]


def _site_text(folder):
    """The single site's text: its part files concatenated in name order."""
    (site_dir,) = [d for d in os.listdir(folder) if d.startswith("site_key=")]
    parts = sorted(f for f in os.listdir(os.path.join(folder, site_dir)) if f.startswith("part-"))
    return "".join(open(os.path.join(folder, site_dir, f), encoding="utf-8").read() for f in parts)


def test_narrow_snapshot_diff_equals_full_diff(spark, tmp_path):
    from conftest import SF_SMALL
    from tidemark.plans.queries import _snapshots

    prev, cur = _snapshots(spark, SF_SMALL)
    prev.write.parquet(str(tmp_path / "prev"))
    cur.write.parquet(str(tmp_path / "cur"))
    p, c = spark.read.parquet(str(tmp_path / "prev")), spark.read.parquet(str(tmp_path / "cur"))
    cols = ["start_url", "change_type", "chunk_id", "url", "heading_path", "text", "chunk_hash", "change_side",
            "pos_seq", "pos_order"]

    def rows(df):
        return sorted(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*cols).collect())

    full = rows(D.diff_chunks(p, c))
    assert len(full) > 1000 and rows(D.diff_snapshots(p, c)) == full
    assert rows(D.diff_snapshots(None, c)) == rows(D.diff_chunks(None, c))


def test_existing_but_empty_state(spark):
    root = tempfile.mkdtemp(prefix="tidemark-empty-")
    state = os.path.join(root, "state")
    dead = {p: "<html><body></body></html>" for p in SPRING}
    raw_dead = _raw(spark, dead).withColumn("status", F.lit(404))
    h1 = run_diff_job(spark, raw_dead, state, os.path.join(root, "r1"), "2026-01-01T00:00:00Z").first()
    assert (h1.summary.added, h1.prev_run_at) == (0, None)
    h2 = run_diff_job(spark, _raw(spark, SPRING), state, os.path.join(root, "r2"), "2026-01-08T00:00:00Z").first()
    assert h2.summary.added == 4 and h2.prev_run_at == "2026-01-01T00:00:00Z"


def test_a_diff_without_texts_shuffles_none(spark):
    """Rows are sorted behind the shuffle only, and a count of changes moves keys, positions and hashes."""
    prev, cur = chunks(spark, MONDAY), chunks(spark, TUESDAY)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kinds = D.diff_chunks(prev, cur).groupBy("change_type").count()
    assert "text#" not in "".join(x for x in plan(kinds).splitlines() if "Exchange" in x or "Project" in x)
    below = plan(D.last_wins(cur)).split("Exchange hashpartitioning")[1]
    assert "Sort" not in below and "Aggregate" not in below
    assert plan(D.diff_snapshots(prev, cur)).count("Exchange hashpartitioning") == 1


def test_diffs_keep_odd_hashes_and_null_keys(spark):
    upper = "sha256:" + "AB" * 32
    odd = [None, "", "md5:1", "sha256:" + "0" * 63, "sha256:" + "g" * 64, upper, upper.lower(), upper.lower() + "0", "sha256:" + "a" * 64]
    rows = [("s", n, f"c{n}", None, None, f"t{n}", 1, h, 0) for n, h in enumerate(odd)] + [("s", 99, None, "u", ["x"], "t", 1, "h", 0)]
    cur = spark.createDataFrame(rows, COLS)
    assert {r.chunk_id: r.chunk_hash for r in D.last_wins(cur).collect()} == {f"c{n}": h for n, h in enumerate(odd)} | {None: "h"}
    prev = cur.withColumn("chunk_hash", F.when(F.col("chunk_id") == "c5", F.lower("chunk_hash")).otherwise(F.col("chunk_hash")))
    cols = ["change_type", "chunk_id", "chunk_hash", "change_side"]
    rows = lambda df: sorted(map(repr, map(tuple, df.select(cols).collect())))
    assert rows(D.diff_chunks(prev, cur)) == sorted(map(repr, [("modified", "c5", upper, 0), ("added", None, "h", 0), ("removed", None, "h", 1)]))
    assert rows(D.diff_snapshots(prev, cur)) == [repr(("modified", "c5", upper, 0))]  # stored runs hold no chunk without an id
