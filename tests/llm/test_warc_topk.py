"""WARC archives and the bit-sliced index on small cases."""

import base64
import hashlib
import io
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bitslice, warc

# --- WARC -------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", -1) for i, u, h in rows], "page_id long, url string, html string, digest string, top int")


def test_round_trip(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "http://c/\r\nX: y", ""), (None, "http://d/", "z"),
            (5, "http://e/", "big\r\n\r\n" * 300_000), (6, "http://f/", "\r\n\r\nWARC/1.1\r\n"), (6, "http://f/", "\r\n\r\nWARC/1.1\r\n")]
    records = warc.write_archives(warc.with_record_types(pages(spark, rows)), archive_bytes=2000)
    back = warc.read_archives(records, keep_payload=True).collect()
    assert records.count() > 1 and len(back) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in back:
        raw = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert r.payload == (raw if r.record_type == "response" else None)
    assert sorted((r.page_id, r.refers_to) for r in back if r.record_type == "revisit") == [(1, 2), (3, 4)]
    assert all("\n" not in r.target_uri for r in back)
    folder = records.first().folder
    assert warc.load(spark, folder).count() == len(rows)
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0
    some = warc.with_record_types(pages(spark, rows), least_bytes=1)
    assert {r.page_id for r in some.where("refers_to is not null").collect()} == {1}


def _archive():
    digest = base64.b32encode(hashlib.sha1(b"body").digest()).decode()
    return warc.page_record(7, "http://x/", b"body", digest, None) + warc.page_record(8, "http://y/", b"body", digest, 7)


def _read(data, step):
    stream = io.BytesIO(data)
    return list(warc.read_records(lambda: stream.read(step), keep_payload=True))


def test_reading_in_any_pieces():
    for step in (1, 2, 7, 64, 10_000):
        got = _read(_archive(), step)
        assert [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"]) for r in got] == [
            (7, "response", None, 4, b"body"), (8, "revisit", 7, 4, None)]


def test_damage_is_an_error():
    whole = _archive()
    first = zlib.decompressobj(31).decompress(whole)

    def packed(raw):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(raw) + c.flush()

    for bad in (whole[:-5], whole[: len(whole) // 2], packed(first.replace(b"body", b"bodi")), packed(first[:-1]), packed(first + b"more"),
                packed(first.replace(b"Content-Length: 4", b"Content-Length: 5")), packed(b"no record"), b"no gzip at all"):
        with pytest.raises(ValueError, match="record 0|record 1"):
            _read(bad, 16)


def test_long_urls(spark):
    rows = [(1, "http://a/" + "é" * 1_500_000, "x"), (2, "http://b/" + "\n" * 700_000, "x"), (3, "c" * 3_000_000, "y")]
    back = {r.page_id: r for r in warc.round_trip(pages(spark, rows)).collect()}
    assert {i: (r.payload_bytes, r.record_type, r.refers_to) for i, r in back.items()} == {1: (1, "revisit", 2), 2: (1, "response", None), 3: (1, "response", None)}
    assert back[1].target_uri == rows[0][1] and back[2].target_uri == "http://b/" + "%0A" * 700_000 and back[3].target_uri == rows[2][1]


def _foreign(kind, name, block, *more):
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Target-URI", "<http://w.example.org/>"), *more]
    return warc._record(fields, block)


def test_foreign_archives(spark, tmp_path):
    http = ("Content-Type", "application/http;msgtype=response")
    body = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nplain body"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 3\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    data = (_foreign("warcinfo", "<urn:uuid:0>", b"software: x") + _foreign("request", "<urn:uuid:1>", b"GET / HTTP/1.1\r\n", ("Content-Type", "application/http;msgtype=request"))
            + _foreign("response", "<urn:uuid:2>", body, http) + _foreign("response", "<urn:uuid:3>", chunked, http, ("WARC-Payload-Digest", "sha1:" + "A" * 32))
            + _foreign("revisit", "<urn:uuid:4>", b"HTTP/1.1 200 OK\r\n\r\n", http, ("WARC-Refers-To", "<urn:uuid:2>"), ("WARC-Payload-Digest", "sha256:00"))
            + _foreign("response", "<urn:uuid:5>", b"\x00dns answer", ("Content-Type", "text/dns")) + _foreign("metadata", "<urn:uuid:6>", b"\r\n\r\n")
            + _foreign("response", "<urn:uuid:7>", b"", http))
    (tmp_path / "a.warc.gz").write_bytes(data)
    rows = {r.record_id: r for r in warc.load(spark, f"file:{tmp_path}", keep_payload=True).collect()}
    assert set(rows) == {f"<urn:uuid:{i}>" for i in (2, 3, 4, 5, 7)} and {r.page_id for r in rows.values()} == {None}
    assert (rows["<urn:uuid:2>"].payload, rows["<urn:uuid:2>"].payload_bytes) == (b"plain body", 10)
    assert rows["<urn:uuid:2>"].payload_digest == base64.b32encode(hashlib.sha1(b"plain body").digest()).decode()
    assert rows["<urn:uuid:3>"].payload_bytes == 15 and rows["<urn:uuid:5>"].payload == b"\x00dns answer"
    assert (rows["<urn:uuid:4>"].refers_to_id, rows["<urn:uuid:4>"].refers_to, rows["<urn:uuid:4>"].payload_bytes) == ("<urn:uuid:2>", None, None)
    assert rows["<urn:uuid:7>"].payload_bytes == 0 and {r.target_uri for r in rows.values()} == {"http://w.example.org/"}


def test_a_lost_attempt_is_not_read(spark):
    rows = warc.with_record_types(pages(spark, [(1, "u", "one"), (2, "u", "two")]))
    records = warc.write_archives(rows)
    stray = os.path.join(records.first().folder.replace("file:", "", 1).replace("//", "/"), "stray.warc.gz")
    with open(stray, "wb") as f:
        f.write(b"half a fi")
    assert warc.read_archives(records).count() == 2


# --- top-k ---------------------------------------------------------------------------------

def _best(rows, k, every):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")


@pytest.mark.parametrize("spread", [0.01, 0.4, 30.0])
def test_exact_with_ties(spark, spread):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, spread, 9)]) for i in rng.permutation(230)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(40)] + [(500, [0.0] * 9), (501, None), (502, [None] * 9), (503, [float("nan")] + [0.0] * 8),
             (504, [float("inf")] * 9), (505, [0.5]), (506, []), (None, [0.1] * 9)]
    got = bitslice.top_k(_vectors(spark, rows), F.col("vec_id") % 5 == 0, k=7)
    assert sorted(tuple(r) for r in got.collect()) == _best(rows, 7, 5)


def test_small_blocks_and_few_rows(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.randint(-4, 4) / 64 for _ in range(3)]) for i in range(150)]
    v = bitslice.quantised(_vectors(spark, rows))
    got = bitslice.search(v.where("vec_id % 10 = 0"), bitslice.build_index(v, block_rows=16), 5, query_block=4)
    assert sorted(tuple(r) for r in got.collect()) == _best(rows, 5, 10)
    three = bitslice.top_k(_vectors(spark, rows[:3]), F.lit(True), k=20)
    assert sorted(tuple(r) for r in three.collect()) == _best(rows[:3], 20, 1)
    assert bitslice.top_k(_vectors(spark, rows).limit(0), F.lit(True)).count() == 0


def _doubles(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def test_only_scores_beyond_a_long_are_refused(spark):
    big = 2.0 ** 55                                               # an integer of 61 bits
    rows = [(0, [big, 1 / 64]), (1, [1 / 64, 1 / 64]), (2, [-1 / 64, 1 / 64]), (3, [0.0, -big])]
    got = bitslice.top_k(_doubles(spark, rows), F.col("vec_id") % 5 != 3, k=3)
    assert sorted(tuple(r) for r in got.collect()) == [x for x in _best(rows, 3, 1) if x[0] != 3]
    for wrong in ([(0, [1e30]), (1, [1.0])], [(0, [big]), (1, [big])]):
        with pytest.raises(Exception, match="too large for a long"):
            bitslice.top_k(_doubles(spark, wrong), F.lit(True)).collect()


def test_repeated_queries_have_rankings_of_their_own(spark):
    rows = [(20, [0.5, 0.25]), (20, [-0.5, 1.0]), *[(i, [i / 64, (15 - i) / 64]) for i in range(1, 16)]]
    got = [tuple(r) for r in bitslice.top_k(_vectors(spark, rows), F.col("vec_id") == 20, k=20).collect()]
    assert len(got) == 30 and sorted(r[1] for r in got) == sorted([*range(1, 16)] * 2)
    want = []
    for _, v in rows[:2]:
        scored = sorted((-sum(int(64 * a) * int(np.floor(64 * b)) for a, b in zip(v, w, strict=True)), i) for i, w in rows[2:])
        want += [(20, n, i, -x) for n, (x, i) in enumerate(scored, 1)]
    assert sorted(got) == sorted(want)


def test_digits_and_adders():
    for q in range(-300, 301):
        d = bitslice.digits(q)
        assert sum(s << w for w, s in d) == q and all(b[0] - a[0] > 1 for a, b in zip(d, d[1:], strict=False))
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 2**63, (40, 3), dtype=np.uint64)
    bits = np.unpackbits(maps.view(np.uint8), axis=1, bitorder="little").astype(int)
    levels = {0: np.arange(17), 2: np.arange(17, 40)}
    total = sum(np.unpackbits(s.view(np.uint8), bitorder="little").astype(int) << w for w, s in enumerate(bitslice.add_slices(maps, levels)))
    assert (total == bits[:17].sum(axis=0) + 4 * bits[17:].sum(axis=0)).all()
