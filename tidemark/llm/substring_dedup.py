"""Removal of repeated byte strings by external induced suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere
goes.  A window (the LENGTH bytes from one place) is led by the least hash among
its K-byte strings; windows in a row with one leader form a segment.  Equal
windows have equal leaders at equal places, so:

1. Segments of all texts are listed (places and hashes only).  Segments whose
   leader occurs once hold no repeated window and go.  Contents are told apart
   by XXH3 hashes of all their bytes (64 bits, besides the leader's hash).  The
   only content of a leader needs no sorting: all its windows are repeated.
2. Other segments of one leader go to one shard, each distinct content once
   (one that occurs again is repeated throughout), and every shard sorts the suffixes of its segments (see suffix.py:
   induced sorting, disk-backed queues in the shared folder, common-prefix
   values).  A window is repeated exactly if its suffix shares LENGTH bytes
   with a neighbour in that order.  A segment holds no window of another one,
   so a text never meets itself at one place.
   A leader with more than GROUP_BYTES of distinct segments is divided first.
   Every window has at least half of the bytes that the leader leaves open on
   its left, or as many on its right; so each segment falls into the windows
   of either kind, grouped by the leader with those bytes.  Equal windows stay
   together.  Groups that are still too large are divided again by the wider
   string in common, at the end by the whole window.
3. Repeated windows go back to all places of their segment, and each text
   joins its spans and loses them.

Defined results: null text is empty; texts shorter than LENGTH lose nothing;
ids may be null or repeat, rows that agree in id and text are each other's
copies; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, hot_keys, join_on, shared_folder, spread_join, stored
from .shingles import _BYTES, _DOWN, _UP, PIECE, mix
from .suffix import Files, Induction

LENGTH = 400
LEADER = 100
SHARD_BYTES = 4 << 20
#: Distinct segments under one leader beyond this are divided; a shard holds a few such groups.
GROUP_BYTES = 4 << 20
QUEUE_BYTES = 64 << 20
_LOW = np.uint64((1 << 22) - 1)
KEY = ["fp", "sh"]


def _hashed(raw: np.ndarray, leader: int) -> np.ndarray:
    """Rolling hashes of the strings of ``leader`` bytes: they choose leaders and groups, where a collision costs time only."""
    m = len(raw) - leader + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * _UP[:len(raw)], dtype=np.uint64)])
    return mix((sums[leader:] - sums[:m]) * _DOWN[:m])


def leader_place(raw: bytes, length: int, leader: int) -> int:
    """Where the leader stands in a segment; all its windows hold the first one's."""
    return int((_hashed(np.frombuffer(raw, np.uint8, length), leader) & ~_LOW).argmin())


def segments(raw: np.ndarray, ends: np.ndarray, length: int, leader: int) -> tuple[np.ndarray, ...]:
    """Segments of documents laid end to end (``ends``: where each stops), at most PIECE bytes in all.

    Returns (document, first window, windows, leader's hash, content's hash).
    """
    n, none = len(raw), tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < length:
        return none
    m = n - leader + 1
    hashes = _hashed(raw, leader)
    key = (hashes & ~_LOW) | np.arange(m, dtype=np.uint64)  # equal hashes: the first place leads
    wide = length - leader + 1
    blocks = -(-m // wide)
    padded = np.full(blocks * wide, ~np.uint64(0))
    padded[:m] = key
    table = padded.reshape(blocks, wide)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    lead = (np.minimum(back[:windows], ahead[wide - 1:wide - 1 + windows]) & _LOW).astype(np.int64)
    begins = np.append(0, ends[:-1])
    doc = np.repeat(np.arange(len(ends)), ends - begins)[:windows]
    inside = np.arange(windows) + length <= ends[doc]
    first = np.flatnonzero(inside & np.append(True, (lead[1:] != lead[:-1]) | ~inside[:-1]))
    if not len(first):
        return none
    # a run of windows ends before the next run or the first window outside
    limit = np.append(first[1:], windows)
    limit = np.minimum(limit, ends[doc[first]] - length + 1)
    stop = limit - 1 + length
    bytes_ = memoryview(raw)
    content = np.fromiter((xxhash.xxh3_64_intdigest(bytes_[a:b]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)), np.uint64, len(first))
    return doc[first], first - begins[doc[first]], limit - first, hashes[lead[first]], content


def _listed(raws: list[bytes], length: int, leader: int) -> Iterator[tuple[np.ndarray, ...]]:
    """segments() over any texts: short ones together, long ones in overlapping pieces."""
    def flush(group, size):
        if group:
            raw = np.frombuffer(b"".join(raws[i] for i in group), np.uint8)
            d, *rest = segments(raw, np.cumsum([len(raws[i]) for i in group]), length, leader)
            yield np.array(group)[d] if len(d) else d, *rest

    group, size, most = [], 0, PIECE // 2
    for i, r in enumerate(raws):
        if len(r) < length:
            continue
        if len(r) > most:
            whole = np.frombuffer(r, np.uint8)
            for at in range(0, len(r) - length + 1, most):
                part = whole[at:at + most + length - 1]
                d, first, *rest = segments(part, np.array([len(part)]), length, leader)
                yield d + i, first + at, *rest
            continue
        if size + len(r) > most:
            yield from flush(group, size)
            group, size = [], 0
        group.append(i)
        size += len(r)
    yield from flush(group, size)


def segment_table(texts: DataFrame, length: int, leader: int) -> DataFrame:
    """(doc_id, th, text) -> doc_id, th, a (first window), own (windows), fp, sh."""
    def run(batches):
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 512):
                raws = [(t or "").encode("utf-8") for t in batch.column(2).slice(at, 512).to_pylist()]
                for d, a, own, fp, sh in _listed(raws, length, leader):
                    if len(d):
                        where = pa.array(d + at)
                        yield pa.RecordBatch.from_arrays([ids.take(where), th.take(where), pa.array(a), pa.array(own.astype(np.int32)),
                                                          pa.array(fp.astype(np.int64)), pa.array(sh.astype(np.int64))], names=["doc_id", "th", "a", "own", "fp", "sh"])

    return texts.mapInArrow(run, "doc_id long, th long, a long, own int, fp long, sh long")


def _contents(groups: DataFrame, texts: DataFrame, length: int, leader: int | None = None) -> DataFrame:
    """Bytes of each distinct segment: fp, sh, own, times (1, or 2 if it occurs again), raw (with ``leader`` its place, too)."""
    fields = [("fp", pa.int64()), ("sh", pa.int64()), ("own", pa.int32()), ("times", pa.int32()), ("raw", pa.binary())]
    spec = "fp long, sh long, own int, times int, raw binary"
    if leader:
        fields, spec = [*fields, ("at", pa.int32())], spec + ", at int"
    wanted = groups.select("rep.doc_id", "rep.th", F.struct("fp", "sh", "rep.a", "rep.own", F.least("n", F.lit(2)).cast("int").alias("times")).alias("s"))
    wanted = wanted.groupBy("doc_id", "th").agg(F.collect_list("s").alias("s"))  # bounded by the text's own length

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = {k: [] for k, _ in fields}
                part = batch.slice(at, 256)
                for text, s in zip(part.column("text").to_pylist(), part.column("s").to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8")
                    for x in s:
                        for k in ("fp", "sh", "own", "times"):
                            out[k].append(x[k])
                        out["raw"].append(raw[x["a"]:x["a"] + x["own"] - 1 + length])
                        if leader:
                            out["at"].append(leader_place(out["raw"][-1], length, leader))
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(fields))

    return join_on(texts, wanted, ["doc_id", "th"]).select("text", "s").mapInArrow(cut, spec)


def _halves(pieces: DataFrame, length: int, core: int) -> DataFrame:
    """Each piece as two, whose windows hold ``half`` more bytes left of the ``core`` bytes at ``at``, or right of them."""
    half = (length - core + 1) // 2
    left = F.greatest(F.lit(0), F.least(F.col("own"), F.col("at") - half + 1))
    raw = F.col("raw")
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.col("off").alias("off"), left.alias("own"), (F.col("at") - half).alias("at"),
                 raw.substr(F.lit(1), left - 1 + length).alias("raw")),
        F.struct(F.lit(1).alias("side"), (F.col("off") + left).alias("off"), (F.col("own") - left).alias("own"), (F.col("at") - left).alias("at"),
                 raw.substr(left + 1, F.col("own") - left - 1 + length).alias("raw")))
    out = pieces.select("fp", "sh", "times", "key", F.explode(both).alias("x")).where("x.own > 0").select("fp", "sh", "times", "key", "x.*")
    key = F.xxhash64("key", "side", F.col("raw").substr(F.col("at") + 1, F.lit(core + half)))
    return out.select("fp", "sh", "off", "own", "times", key.alias("key"), F.xxhash64("raw").alias("h"), "at", "raw")


def divided(contents: DataFrame, length: int, leader: int, group_bytes: int) -> list[tuple[DataFrame, DataFrame | None]]:
    """Segments under hot leaders as pieces: fp, sh, off (first window in the segment), own, times, key, h, at, raw.

    Stored tables, each with the keys that the next one holds in halves (see _cool).  The pieces of any other
    key have at most ``group_bytes`` of distinct contents (key, h), or are one window.
    """
    rest = contents.select("fp", "sh", F.lit(0).alias("off"), "own", "times", F.col("fp").alias("key"), "at", "raw")
    core, done = leader, []
    while core < length:
        pieces, core = stored(_halves(rest, length, core), "pieces"), core + (length - core + 1) // 2
        distinct = pieces.groupBy("key", "h").agg(F.first("own").alias("own"))
        sizes = distinct.groupBy("key").agg(F.sum(F.col("own") + length).alias("bytes"))
        hot = stored(sizes.where(F.col("bytes") > group_bytes).select("key"), "hot-pieces")  # at most one per ``group_bytes`` of the data
        if core >= length or hot.isEmpty():
            return [*done, (pieces, None)]
        done.append((pieces, hot))
        rest = pieces.join(F.broadcast(hot), "key", "left_semi")
    return [(stored(rest.withColumn("h", F.col("sh")), "pieces"), None)]  # a leader as long as a window


def _cool(tables: list, *cols: str) -> DataFrame:
    """The named columns of all pieces that are not divided further."""
    parts = [t.select(*cols) if hot is None else t.join(F.broadcast(hot), "key", "left_anti").select(*cols) for t, hot in tables]
    return functools.reduce(DataFrame.union, parts)


def repeated_windows(contents: DataFrame, shards: int, length: int, folder: str, queue_bytes: int = QUEUE_BYTES, base: int = 1 << 23) -> DataFrame:
    """fp, sh, runs (first and last+1 repeated window of the segment), by suffix sorting in shards."""
    def run(batches):
        seen, parts, owns, keys, several = set(), [], [], [], []
        for batch in batches:
            for fp, sh, own, times, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (fp, sh) not in seen:  # rows that agree in id and text bring a segment again
                    seen.add((fp, sh))
                    parts.append(raw)
                    owns.append(own)
                    keys.append((fp, sh))
                    several.append(times > 1)
        kinds = Counter(fp for fp, _ in keys)
        out = {"fp": [], "sh": [], "runs": []}

        def add(key, run_edges):
            for k, v in zip(out, (*key, run_edges), strict=True):
                out[k].append(v)

        for key, own, again in zip(keys, owns, several, strict=True):
            if again:  # every window of it is repeated
                add(key, [0, own])
        # the only content of its leader meets no other one
        open_ = [i for i, (fp, _) in enumerate(keys) if kinds[fp] > 1]
        parts, owns, keys, several = ([x[i] for i in open_] for x in (parts, owns, keys, several))
        if not all(several):
            text, starts, at = np.empty(sum(len(r) + 1 for r in parts) + 1, np.uint16), [], 0
            for raw in parts:
                starts.append(at)
                text[at:at + len(raw)] = np.frombuffer(raw, np.uint8)
                text[at:at + len(raw)] += 2
                at += len(raw)
                text[at] = 1  # no text goes on here
                at += 1
            text[at] = 0
            del parts, seen
            files = Files(folder)
            try:
                hits = Induction(length, files, queue_bytes, base).repeated(text)
            finally:
                files.close()
            for key, a, own, again in zip(keys, starts, owns, several, strict=True):
                hit = hits[a:a + own]
                if not again and hit.any():
                    add(key, np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("fp", pa.int64()), ("sh", pa.int64()), ("runs", pa.list_(pa.int32()))]))

    return contents.repartition(shards, "fp").mapInArrow(run, "fp long, sh long, runs array<int>")


def repeated_spans(texts: DataFrame, length: int = LENGTH, leader: int = LEADER, shard_bytes: int = SHARD_BYTES,
                   queue_bytes: int = QUEUE_BYTES, base: int = 1 << 23, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, th, text) -> doc_id, th, found: places and repeated windows of its segments, for texts that have any."""
    every = stored(segment_table(texts, length, leader), "segments")
    leaders = stored(every.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "repeated-leaders")
    total = every.count()
    listed = stored(spread_join(every, leaders.select("fp"), ["fp"], hot_keys(leaders, "c", total), ["doc_id", "a"], "left_semi"), "repeated-segments")
    discard(every)
    distinct = stored(listed.groupBy("fp", "sh").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "a", "own")).alias("rep")), "distinct-segments")
    sizes = stored(distinct.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("rep.own") + length).alias("bytes")), "leaders")
    # the only content of a leader: all its windows are repeated, and no other segment has any of them
    groups = stored(spread_join(distinct, sizes, ["fp"], hot_keys(sizes, "kinds", distinct.count()), ["sh"]), "sized-segments")
    alone = groups.where("kinds = 1").select("fp", "sh", F.array(F.lit(0), F.col("rep.own")).alias("runs"))
    contested, sizes = groups.where("kinds > 1"), sizes.where("kinds > 1")
    size = sizes.where(F.col("bytes") <= group_bytes).agg(F.sum("bytes")).first()[0] or 0
    hot, tables = sizes.where(F.col("bytes") > group_bytes).select("fp"), []  # at most one per ``group_bytes`` of the data
    contents = _contents(contested, texts, length)
    if not hot.isEmpty():
        tables = divided(_contents(contested.where(F.col("bytes") > group_bytes), texts, length, leader), length, leader, group_bytes)
        pieces = _cool(tables, "key", "h", "own", "times", "raw").groupBy("key", "h")
        pieces = pieces.agg(F.first("own").alias("own"), F.least(F.sum("times"), F.lit(2)).cast("int").alias("times"), F.first("raw").alias("raw"))
        size += _cool(tables, "own").agg(F.sum(F.col("own") + length)).first()[0] or 0
        contents = _contents(contested.where(F.col("bytes") <= group_bytes), texts, length).union(pieces)
    runs = repeated_windows(contents, max(1, -(-size // shard_bytes)), length,
                            shared_folder(texts.sparkSession, "suffix-queues"), queue_bytes, base)
    runs = stored(runs.union(alone), "repeated-windows")
    if tables:
        # rows that agree in id and text bring a piece again
        places = _cool(tables, "fp", "sh", "off", "key", "h").distinct().select(F.col("fp").alias("_fp"), F.col("sh").alias("_sh"), "off", F.col("key").alias("fp"), F.col("h").alias("sh"))
        found = places.join(runs, KEY).select("_fp", "_sh", F.transform("runs", lambda x: x + F.col("off")).alias("runs"))
        runs = stored(runs.union(found), "repeated-windows")
        discard(*(t for t, _ in tables))
    often = stored(hot_keys(groups, "n", total).select(*KEY), "frequent-segments")
    discard(distinct, groups)
    return spread_join(listed, runs, KEY, often, ["doc_id", "a"]).groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "runs")).alias("found"))  # bounded by the text's own length


def merged_spans(found: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte spans [start, end) covered by repeated windows, joined where they touch."""
    windows = sorted((x["a"] + x["runs"][i], x["a"] + x["runs"][i + 1] - 1 + length) for x in found for i in range(0, len(x["runs"]), 2))
    out: list[tuple[int, int]] = []
    for a, b in windows:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: bool = False, **kw) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (with ``keep`` also spans and kept bytes)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    found = repeated_spans(texts, length, **kw)
    spec = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    if keep:
        spec += ", spans array<array<long>>, kept binary"
        fields += [("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, text, hits in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "found")), strict=True):
                    raw = (text or "").encode("utf-8")
                    spans = merged_spans(hits or [], length)
                    kept, last = [], 0
                    for a, b in spans:
                        kept.append(raw[last:a])
                        last = b
                    left = b"".join([*kept, raw[last:]])
                    row = [doc, len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest()]
                    rows.append(row + [[list(s) for s in spans], left] if keep else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], names=[f[0] for f in fields])

    return join_on(texts, found, ["doc_id", "th"], "left").select("doc_id", "text", "found").mapInArrow(cut, spec)
