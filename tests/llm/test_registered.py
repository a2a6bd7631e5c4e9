"""Registered queries over whole tables against SQL or plain versions."""

import hashlib
import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL

from check_oracles import _canon
from tidemark.llm.queries import REGISTRY, SQL


def _same(a, b):
    for d in (a, b):
        for c in d.columns:
            if d[c].isna().any():
                d[c] = d[c].astype("float64").fillna(-7)
    return [x.replace(".0\x1f", "\x1f") for x in _canon(a)] == [x.replace(".0\x1f", "\x1f") for x in _canon(b)]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    a, b = REGISTRY[name](spark, SF_SMALL).toPandas(), con.sql(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b) > 0
    assert _same(a, b)


def _documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def test_op4(spark):
    from tokenizers import Tokenizer

    from tidemark.llm.packing import vocabulary_path

    coder = Tokenizer.from_file(vocabulary_path())
    ids = {d: coder.encode(t or "", add_special_tokens=False).ids + [2] for d, t in _documents(spark)}
    rows = REGISTRY["op4_best_two_fit_packing"](spark, SF_SMALL).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    for v in bins.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 1024
    for d, v in pieces.items():
        at = 0
        for i, (piece, start, length) in enumerate(sorted(v)):
            assert (piece, start) == (i, at) and (length == 1024 or i == 0)
            at += length
        assert at == len(ids[d])
    assert len(bins) <= 1.03 * -(-sum(r.length for r in rows) // 1024) + 1


def test_op6(spark):
    docs = _documents(spark)
    got = {r.doc_id: r for r in REGISTRY["op6_induced_suffix_dedup"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for (d, t), (kept, spans) in zip(docs, brute.removed_bytes([t for _, t in docs], 400), strict=True):
        n = len((t or "").encode())
        assert tuple(got[d])[1:] == (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())


def test_op7(spark):
    docs = _documents(spark)
    got = sorted(tuple(r) for r in REGISTRY["op7_token_combination_join"](spark, SF_SMALL).collect())
    assert got == sorted(brute.jaccard_components(docs))


def test_op8(spark):
    docs = dict(_documents(spark))
    rows = REGISTRY["op8_hypergeometric_sharding"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    slots = defaultdict(list)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert set(slots) == set(range(16)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_op5_rows(spark):
    rows = REGISTRY["op5_toxicity_crf"](spark, SF_SMALL).collect()
    docs = dict(_documents(spark))
    assert len(rows) == len(docs)
    for r in rows:
        assert all(docs[r.doc_id][s.start:s.end].strip() and s.p >= 0.5 for s in r.spans)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
