"""Best-two-fit packing of tokenised documents into fixed-length sequences.

1. Tokenise: each document becomes pieces of at most ``capacity`` ids.
2. Plan: only how many pieces have which length matters, so the plan is made
   from ``capacity`` counts.  A bin is filled greedily, largest first; then its
   smallest piece is replaced by the two unpacked pieces that fit the gap it
   leaves (its own length and the rest) most tightly, if they fill more.  The
   bin is repeated as often as the counts allow.
3. Place: pieces are numbered within their length, in two levels so that no
   length meets in one task, and looked up in the plan.

Defined results: null and empty texts are documents with the end id alone;
null ids and repeated rows are documents of their own; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bucket, prefix_sum, stored

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Buckets in which the pieces of one length are numbered at least, and the pieces that a bucket should hold.
BUCKETS, BUCKET_PIECES = 256, 1 << 20
#: Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The rank coder's pattern engine steps back through white space on a stack that ends near a million characters.
BLANKS = 1 << 16
_BLANK = re.compile(r"\s+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _ranked(spec: dict):
    """The same vocabulary as a rank coder, several times faster; None where the vocabulary is of another kind.

    Only for plain byte-level merges whose results are numbered in order of the merges.
    """
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    odd = spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or odd:
        return None
    merged = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        return None
    letters, special = _byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
    return tiktoken.Encoding(name="own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Coder:
    """Texts to the vocabulary's ids, as little-endian unsigned 32-bit bytes.

    Names of added tokens are ordinary text, or with ``added`` become those tokens, as ``tokenizers`` does it by itself.
    """

    def __init__(self, path: str, added: bool = False):
        self.path, self.added = path, added
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranked = _ranked(spec)
        self.names = [t["content"] for t in spec.get("added_tokens", [])] if added else []

    @functools.cached_property
    def coder(self):
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(self.path)
        coder.encode_special_tokens = not self.added
        return coder

    def fits(self, text: str) -> bool:
        """Whether the rank coder takes the text; runs of ``BLANKS`` and more, and added tokens, go to ``tokenizers``."""
        if any(name in text for name in self.names):
            return False
        return len(text) < BLANKS or all(m.end() - m.start() < BLANKS for m in _BLANK.finditer(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked is not None:
            coded = (self.ranked.encode_ordinary(t) if self.fits(t) else self.coder.encode(t, add_special_tokens=False).ids for t in texts)
            return [np.array(ids, "<u4").tobytes() for ids in coded]
        return [np.array(e.ids, "<u4").tobytes() for e in self.coder.encode_batch(texts, add_special_tokens=False)]


@functools.lru_cache(maxsize=2)
def coder_of(path: str) -> Coder:
    """One coder a worker process, whatever the number of its tasks."""
    return Coder(path, added=True)


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as little-endian bytes).

    Documents longer than ``capacity`` are cut into full pieces; the first piece may be shorter.
    """
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                       + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols = [[] for _ in schema]
                for doc, raw in zip(part.column(0).to_pylist(), coder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    raw += end
                    n = len(raw) // 4
                    cut = n % capacity or capacity
                    for piece, start in enumerate([0, *range(cut, n, capacity)]):
                        stop = min(n, start + (capacity if piece else cut))
                        ids = raw[4 * start:4 * stop]
                        for col, x in zip(cols, (doc, piece, start, stop - start, zlib.crc32(ids), ids), strict=False):
                            col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    spec = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, spec)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """counts[length] -> (pieces per length in a bin, number of such bins), covering all counts."""
    left = counts.astype(np.int64).copy()
    plan = []
    while left.any():
        free = left.copy()
        use: dict[int, int] = {}
        gap = capacity
        while gap and (fits := np.flatnonzero(free[:gap + 1])).size:
            x = int(fits[-1])
            n = int(min(free[x], gap // x))
            use[x] = use.get(x, 0) + n
            free[x] -= n
            gap -= n * x
        small = min(use)
        if gap and sum(use.values()) > 1:
            # two others of the lengths still free, as long as possible within the expanded gap
            room = gap + small
            a = np.flatnonzero(free[:room])
            a = a[a > 0]
            if a.size:
                last = np.maximum.accumulate(np.where(free[:capacity + 1] > 0, np.arange(capacity + 1), 0))
                lone = np.maximum.accumulate(np.where(free[:capacity + 1] > 1, np.arange(capacity + 1), 0))
                b = last[np.minimum(a - 1, room - a)]
                b = np.maximum(b, np.where((2 * a <= room) & (lone[a] == a), a, 0))
                both = np.where(b > 0, a + b, 0)
                best = int(both.argmax())
                if both[best] > small:
                    use[small] -= 1
                    if not use[small]:
                        del use[small]
                    for x in (int(a[best]), int(b[best])):
                        use[x] = use.get(x, 0) + 1
        times = int(min(left[x] // n for x, n in use.items()))
        for x, n in use.items():
            left[x] -= n * times
        plan.append((use, times))
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", key_cols: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32")) -> DataFrame:
    """``pieces`` (stored) with sequence_id and offset."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy(length_col).count().collect():  # at most ``capacity`` rows
        counts[r[length_col]] = r["count"]
    firsts, uses, bases, offsets, lengths = [], [], [], [], []
    taken, base = np.zeros(capacity + 1, np.int64), 0
    for use, times in best_two_fit(counts, capacity):
        offset = 0
        for x in sorted(use, reverse=True):
            lengths.append(x)
            firsts.append(int(taken[x]))
            uses.append(use[x])
            bases.append(base)
            offsets.append(offset)
            taken[x] += use[x] * times
            offset += use[x] * x
        base += times
    order = np.lexsort((firsts, lengths)) if lengths else np.zeros(0, np.int64)
    lengths, firsts, uses, bases, offsets = (np.array(v, np.int64)[order] for v in (lengths, firsts, uses, bases, offsets))
    starts = (lengths << 48) | firsts  # plan entries sorted by (length, first rank); bounded by capacity, not by the data

    buckets = max(BUCKETS, int(counts.max()) // BUCKET_PIECES)
    ranked = prefix_sum(pieces.withColumn("_b", hash_bucket(buckets, *key_cols)), [length_col], "_b", list(key_cols), F.lit(1).cast("long"), "_rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (length_col, "_rank"))
            at = np.searchsorted(starts, (size << 48) | rank, side="right") - 1
            nth = rank - firsts[at]
            cols = [batch.column(c) for c in names] + [pa.array(bases[at] + nth // uses[at]), pa.array(offsets[at] + nth % uses[at] * size)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    return ranked.select(*names, "_rank").mapInArrow(place, fields)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, **kw) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (ids), sequence_id, offset."""
    return pack_pieces(stored(token_pieces(docs, id_col, text_col, capacity=capacity, **kw), "token-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids -> one row per sequence: ids (array of int) and document starts; at most ``capacity`` ids each."""
    @F.pandas_udf("array<long>")
    def unpacked(ids):
        return ids.map(lambda b: np.frombuffer(b, "<u4").astype(np.int64))

    parts = packed.select("sequence_id", F.struct("offset", unpacked("ids").alias("ids"), "doc_id").alias("p"))
    rows = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return rows.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                       F.transform("p", lambda x: x["offset"]).alias("starts"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
