"""Delivery (index merge, store sink, message) and enrichment hooks."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import deliver as K
from tidemark.operators import diff as D
from tidemark.operators import enrich as N

CHANGE_COLS = "start_url string, change_type string, chunk_id string, url string, heading_path array<string>, text string, chunk_hash string"
TEA, JAM = "https://tea.example.org/", "https://jam.example.org/"


def changes(spark, site=TEA):
    rows = [(site, "added", "shop/oolong", f"{site}oolong", ["Leaves", "Half dark"], "steep four minutes", "sha256:1"),
            (site, "modified", "shop/green", f"{site}green", ["Leaves"], "eighty degrees", "sha256:2"),
            (site, "removed", "shop/dust", f"{site}dust", ["Leaves", "Rest"], "sweepings", "sha256:3")]
    return spark.createDataFrame(rows, CHANGE_COLS)


def index(spark, site=TEA):
    rows = [(site, i, d, (f"{site}{i}", "Leaves", "sha256:0")) for i, d in (("shop/dust", "sweepings"), ("shop/green", "boil it"), ("shop/black", "three minutes"))]
    return spark.createDataFrame(rows, "start_url string, id string, document string, metadata struct<url:string,heading_path:string,chunk_hash:string>")


def test_apply_changes(spark):
    new = {r.id: r for r in K.apply_changes(index(spark), changes(spark)).collect()}
    assert {i: r.document for i, r in new.items()} == {"shop/oolong": "steep four minutes", "shop/green": "eighty degrees", "shop/black": "three minutes"}
    assert new["shop/oolong"].metadata.heading_path == "Leaves > Half dark"
    assert tuple(K.index_apply_counts(changes(spark)).first()) == (2, 1)
    none = changes(spark).limit(0)
    assert K.apply_changes(index(spark), none).count() == 3 and tuple(K.index_apply_counts(none).first()) == (0, 0)


def test_two_sites_may_hold_one_id(spark):
    both = index(spark, TEA).unionByName(index(spark, JAM))
    rows = K.apply_changes(both, changes(spark, TEA)).collect()
    assert len(rows) == len({(r.start_url, r.id) for r in rows}) == 6
    assert {r.id: r.document for r in rows if r.start_url == JAM} == {"shop/dust": "sweepings", "shop/green": "boil it", "shop/black": "three minutes"}
    with pytest.raises(ValueError, match="several sites"):
        K.write_to_store(changes(spark, TEA).unionByName(changes(spark, JAM)), lambda: None)


def test_index_straight_from_the_runs(spark):
    cols = "start_url string, page_seq long, chunk_id string, url string, heading_path array<string>, text string, chunk_hash string, order int"

    def run(items):
        return spark.createDataFrame([(TEA, n, c, TEA + c + v, ["P" + v], t, "h" + t, 0) for n, (c, t, v) in enumerate(items)], cols)

    prev, cur = run([("a", "same", "1"), ("b", "old", "1"), ("c", "gone", "1")]), run([("a", "same", "2"), ("b", "new", "2"), ("d", "fresh", "2")])
    before = K.index_rows_flat(D.last_wins(prev).withColumn("change_type", F.lit("added")))
    want = K.apply_changes(before, D.diff_chunks(prev, cur))
    got = K.index_from_snapshots(prev, cur)
    flat = lambda df: sorted((r.id, r.document, r.metadata.url, r.metadata.heading_path, r.metadata.chunk_hash) for r in df.collect())
    assert flat(got) == flat(want) and len(flat(got)) == 3


def test_store_sink(spark, tmp_path):
    out = str(tmp_path / "calls")

    def factory():
        class FileStore:
            def upsert(self, ids, documents, metadatas):
                with open(out, "a") as f:
                    f.write(json.dumps(["upsert", ids, [m["heading_path"] for m in metadatas]]) + "\n")

            def delete(self, ids):
                with open(out, "a") as f:
                    f.write(json.dumps(["delete", ids]) + "\n")
        return FileStore()

    K.write_to_store(changes(spark).coalesce(1), factory)
    calls = [json.loads(line) for line in open(out)]
    assert calls == [["upsert", ["shop/oolong", "shop/green"], ["Leaves > Half dark", "Leaves"]], ["delete", ["shop/dust"]]]
    K.write_to_store(changes(spark).limit(0), factory)      # empty: no calls
    assert len([json.loads(line) for line in open(out)]) == len(calls)


def test_message_and_row_shapes(spark):
    s = spark.createDataFrame([(TEA, 4, 0, 9)], "start_url string, added long, modified long, removed long")
    m = K.change_notification(s, "Teapot").first()
    assert m.text.startswith("Teapot") and "+4" in m.text and "-9" in m.text and json.loads(m.payload) == {"text": m.text}
    e = N.embed_changes(changes(spark), lambda texts: [[float(sum(map(ord, t)) % 97), -1.0] for t in texts])
    rows = {r.chunk_id: r for r in K.index_rows_json_embedding(e).collect()}
    assert list(rows["shop/green"].embedding) == [float(sum(map(ord, "eighty degrees")) % 97), -1.0]
    assert json.loads(rows["shop/oolong"].metadata)["heading_path"] == "Leaves > Half dark" and rows["shop/green"].start_url == TEA
    items = K.index_rows_vector_item(e, "north").collect()
    assert {(i.namespace, i.item.metadata.document) for i in items} == {("north", "steep four minutes"), ("north", "eighty degrees")}


def test_removed_chunks_never_reach_the_summarizer(spark):
    def shout(rec):
        assert rec["text"] != "sweepings"
        return rec["text"].upper(), [rec["heading_path_text"]]

    got = {r.chunk_id: (r.summary, list(r.tags)) for r in N.enrich_changes(changes(spark), shout).collect()}
    assert got == {"shop/oolong": ("STEEP FOUR MINUTES", ["Leaves > Half dark"]), "shop/green": ("EIGHTY DEGREES", ["Leaves"]),
                   "shop/dust": ("Removed: Leaves > Rest", ["removed"])}


def test_parse_both_response_forms(spark):
    inner = json.dumps({"summary": "S", "tags": ["a", "b"]})
    rows = [("1", json.dumps({"choices": [{"message": {"content": inner}}]})),
            ("2", json.dumps({"content": [{"type": "text", "text": inner}]})),
            ("3", json.dumps({"content": [{"type": "text", "text": json.dumps({"other": 1})}]})),
            ("4", json.dumps({"content": [{"type": "text", "text": "not json"}]}))]
    df = spark.createDataFrame(rows, "id string, response string")
    got = {r.id: r for r in N.enrich_parsed(df).collect()}
    assert (got["1"].summary, list(got["1"].tags)) == ("S", ["a", "b"])
    assert (got["2"].summary, list(got["2"].tags)) == ("S", ["a", "b"])
    assert (got["3"].summary, list(got["3"].tags), got["3"].parse_error) == ("", [], False)
    assert got["4"].parse_error and got["4"].summary is None


def test_requests(spark):
    r = json.loads(N.enrich_requests_chat(changes(spark), "m", "Be brief.").first().request)
    assert r["temperature"] == 0 and r["response_format"] == {"type": "json_object"}
    assert r["messages"][1]["content"].startswith("[added] Leaves > Half dark\n\nsteep")
    r2 = json.loads(N.enrich_requests_messages(changes(spark), "m", "Be brief.").first().request)
    assert r2["max_tokens"] == 200 and r2["system"] == "Be brief." and r2["messages"][0]["role"] == "user"
    assert N.enrich_requests_chat(changes(spark), "m", "Be brief.").where(F.col("change_type") == "removed").count() == 0


def test_summarizer_factory(spark):
    def factory():
        prefix = "made on executor"
        return lambda rec: (f"{prefix}: {rec['chunk_id']}", [rec["change_type"]])

    got = {r.chunk_id: r.summary for r in N.enrich_changes(changes(spark), summarizer_factory=factory).collect()}
    assert got["shop/green"] == "made on executor: shop/green" and got["shop/dust"].startswith("Removed:")


def test_enriching_reads_the_changes_once(spark):
    """Removed rows pass the summarizer by in the same pass."""
    rows = [("s", t, t, "u", ["a", "b"], "words", "h") for t in ("added", "modified", "removed", "other")]
    changes = spark.createDataFrame(rows, "start_url string, change_type string, chunk_id string, url string, heading_path array<string>, text string, chunk_hash string")

    def summarize(rec):
        assert rec["change_type"] != "removed" and set(rec) == {"start_url", "chunk_id", "change_type", "url", "text", "chunk_hash", "heading_path_text", "heading_path"}
        return rec["heading_path_text"], [rec["text"]]

    got = N.enrich_changes(changes, summarize)
    assert sorted((r.chunk_id, r.summary, list(r.tags)) for r in got.collect()) == [("added", "a > b", ["words"]), ("modified", "a > b", ["words"]), ("removed", "Removed: a > b", ["removed"])]
    assert "Union" not in got._jdf.queryExecution().executedPlan().toString()
