"""What long queries leave on disk and move: shuffle files go, hashes of texts do not travel, stored rows are dealt once."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F
from test_diff_state_jobs import COLS, MONDAY, TUESDAY, chunks

from tidemark.operators import deliver as K
from tidemark.operators import diff as D
from tidemark.operators import discover as X
from tidemark.operators import order as O
from tidemark.operators.outbox import Outbox, deliver
from tidemark.plans import jobs as J
from tidemark.plans.queries import _NoStore
from tidemark.session import dealt_by_one_key
from tidemark.sources import state as S
from tidemark.sources.index_store import IndexStore


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> list[str]:
    return [x for x in _plan(df).splitlines() if " Exchange " in x]


def _shuffles(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {os.path.basename(f) for f in files if "/shuffle_" in f and f.endswith(".data")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    prev, cur = chunks(spark, MONDAY * 9), chunks(spark, TUESDAY * 9)
    state, store = S.Snapshots(spark, str(tmp_path / "state")), IndexStore(spark, str(tmp_path / "index"))
    before = _shuffles(spark)
    state.save(prev, "1")
    assert not _shuffles(spark) - before
    store.create(K.index_in_buckets(prev, 8), buckets=8)
    assert not _shuffles(spark) - before
    changes = J._write_read(spark, D.diff_chunks(prev, cur, whole=True), str(tmp_path / "changes"))
    assert not _shuffles(spark) - before
    Outbox(spark, str(tmp_path / "outbox")).fill(changes)
    X._LevelStore(spark).put(cur.repartition("chunk_id"), "level")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert not _shuffles(spark) - before and spark.conf.get(key) == "false"  # the session's own queries keep theirs


ODD = [None, "", "md5:1", "sha256:" + "0" * 63, "sha256:" + "AB" * 32, "sha256:" + "ab" * 32]


def test_hashes_of_texts_are_made_again(spark):
    odd = [("s", n, f"c{n}", "u", ["x"], f"t{n}", 1, h, 0) for n, h in enumerate(ODD)] + [("s", 9, "c9", "u", None, None, 1, "sha256:" + "e3" * 32, 0), ("s", 8, None, "u", [], "t", 1, "h", 0)]
    cur = chunks(spark, TUESDAY + MONDAY[:2]).unionByName(spark.createDataFrame(odd, COLS))
    prev = chunks(spark, MONDAY).unionByName(spark.createDataFrame(odd[1:], COLS).withColumn("chunk_hash", F.lower("chunk_hash")))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(D.last_wins(cur, whole=True)) == rows(D.last_wins(cur))
    assert rows(D.diff_chunks(prev, cur, whole=True)) == rows(D.diff_chunks(prev, cur))
    assert rows(D.diff_snapshots(prev, cur, whole=True)) == rows(D.diff_snapshots(prev, cur))
    assert rows(D.unpack_hash(D.pack_hash(cur, True), True).select(cur.columns)) == rows(cur)
    packed = D.pack_hash(cur, True)
    assert {r.chunk_id: (r.chunk_hash, r._sha) for r in packed.collect()}["boats.example.org/yawl"] == (None, b"")


def test_stored_chunks_are_dealt_once(spark, tmp_path):
    """Marks made as chunks are written spare the digests a shuffle of ids and hashes, and equal what a diff would find."""
    state = S.Snapshots(spark, str(tmp_path / "state"))
    cur = chunks(spark, [*TUESDAY, *MONDAY, ("punt", "again"), ("yawl", "again")])
    commit = state.stage(cur)
    stored = state._staged(commit, "chunks", S.CHUNK_ROWS)
    assert not any("chunk_id" in x or "_sha" in x for x in _exchanges(S.range_digests(stored)))
    sha = {r.chunk_id: hashlib.sha256(f"{r.chunk_id}\x1f{r.chunk_hash}".encode()).hexdigest() for r in D.last_wins(cur).collect()}
    sums = state.staged_digests(commit).agg(*[F.sum(c) for c in ("keys", "digest1", "digest2")]).first()
    assert tuple(map(int, sums)) == (len(sha), sum(int(x[:15], 16) for x in sha.values()), sum(int(x[15:30], 16) for x in sha.values()))
    won = {r.chunk_id: (r.text, r.first_at.s if r.first_at else r.page_seq) for r in state.staged_winners(commit).collect()}
    assert won == {r.chunk_id: (r.text, r.pos_seq) for r in D.last_wins(cur).collect()}
    assert set(state.staged_chunks(commit).columns).isdisjoint(S.MARKS) and state.staged_chunks(commit).count() == 10


def test_runs_stored_without_marks_are_read(spark, tmp_path):
    state = S.Snapshots(spark, str(tmp_path / "state"))
    old, new = chunks(spark, MONDAY * 2), chunks(spark, [*TUESDAY, ("ketch", "three masts"), ("yawl", "again")])
    commit = state.save(old, "1")
    folder = f"{state.runs.root}/chunks/commit={commit}"
    bare = spark.createDataFrame(spark.read.parquet(folder).drop(*S.MARKS).collect(), spark.read.parquet(folder).drop(*S.MARKS).schema)
    bare.write.mode("overwrite").partitionBy("site_bucket").parquet(folder)
    later = state.stage(new)
    cols = ["change_type", "chunk_id", "text", "chunk_hash", "pos_seq", "pos_order"]
    for whole in (True, False):
        got = J.changes_since(state, later, state.previous("2"), whole)
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, D.diff_chunks(old, new).select(cols).collect()))


def test_audit_takes_changes_where_they_lie(spark):
    prev, cur = chunks(spark, MONDAY), chunks(spark, TUESDAY)
    dealt = D._diff_snapshots(prev, cur)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(_exchanges(D.change_audit(dealt, prev, cur))) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert D.change_audit(dealt, prev, cur).count() == 0
    assert D.change_audit(dealt.withColumn("change_type", F.lit("added")), prev, cur).count() == 2


@pytest.mark.parametrize("twice", [False, True])
def test_merge_deals_each_side_once(spark, twice):
    """The rows of the join, also where keys repeat or are null."""
    old = K.index_from_snapshots(None, chunks(spark, MONDAY))
    changes = D.diff_chunks(chunks(spark, MONDAY), chunks(spark, TUESDAY))
    if twice:
        null = {"id": F.lit(None).cast("string")}
        old = old.union(old).union(old.limit(2).withColumns(null)).union(old.limit(1).withColumn("metadata", F.when(F.lit(False), F.col("metadata"))))
        none = {"chunk_id": F.lit(None).cast("string")}
        changes = changes.union(changes).union(changes.withColumns(none)).union(changes.limit(1).withColumn("change_type", F.lit(None).cast("string")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with dealt_by_one_key(spark):
            new = K.apply_changes_in_buckets(old, changes, 4)
            below = _plan(new).split("SortMergeJoin")
            assert below[0].count("Exchange") == 0 and len(below) >= 2
            rows = sorted(map(repr, new.drop("bucket").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == sorted(map(repr, K.apply_changes(old, changes).collect()))


def test_first_index_is_dealt_once(spark):
    cur = chunks(spark, [*TUESDAY, *MONDAY])
    new = K.index_in_buckets(cur, 4)
    assert len(_exchanges(new)) == 1
    assert sorted(map(repr, new.drop("bucket").collect())) == sorted(map(repr, K.index_from_snapshots(None, cur).collect()))
    store = IndexStore(spark, "/nowhere")
    assert new.where(F.col("bucket") != store.bucket(4)).count() == 0


def test_numbered_rows_are_shuffled_once(spark):
    rows = chunks(spark, [(f"n{i}", str(i)) for i in range(50)]).unionByName(chunks(spark, [(f"m{i}", str(i)) for i in range(30)], "https://two/"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(X.number_within(rows.repartition(7), "start_url", ("order", "page_seq"), X._LevelStore(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "row_number" not in p
    got = X.number_within(rows.repartition(7), "start_url", ("order", "page_seq"), X._LevelStore(spark)).collect()
    assert len(got) == 80 and all(r._rn == r.page_seq + 1 for r in got)
    numbered = O.diff_ordered(D.diff_chunks(None, rows)).collect()
    assert sorted((r.start_url, r.seq) for r in numbered) == sorted((r.start_url, r.page_seq + 1) for r in rows.collect())
    assert {r.chunk_id: r.chunk_hash for r in numbered} == {r.chunk_id: r.chunk_hash for r in rows.collect()}


def test_a_filled_outbox_keeps_one_copy(spark, tmp_path):
    root = str(tmp_path / "outbox")
    changes = D.diff_chunks(chunks(spark, MONDAY), chunks(spark, TUESDAY)).withColumn("chunk_hash", F.when(F.col("chunk_id").endswith("yawl"), F.lit("md5:1")).otherwise(F.col("chunk_hash")))
    ledger = deliver(spark, changes, root, _NoStore, batch_rows=1)
    assert {r.route: r.n for r in ledger.groupBy("route").agg(F.sum("rows").alias("n")).collect()} == {"upsert": 2, "delete": 1}
    assert not os.path.exists(f"{root}/rows")
    assert {r.chunk_hash for r in spark.read.parquet(f"{root}/batches").where("chunk_id like '%yawl'").collect()} == {"md5:1"}
