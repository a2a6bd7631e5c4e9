"""Exact top-k search with a bit-sliced index.

Components are quantised to integers.  The index keeps, per block of rows and
per dimension, one bitmap for each bit of the shifted component.  A query's
inner product is a sum of these slices: its digits choose slices (or their
complements, for negative digits) at their weights, and carry-save adders of
AND, OR and XOR add all bitmaps of a weight for every row of the block at
once.  The result slices are read from the most significant downward: rows
certain to be among the best are set aside, rows that may be are narrowed, and
rows that tie at the boundary are resolved by row order, which is id order.

The index is a table of blocks, the queries a table of query blocks; every
pair of them is one unit of work, and only each unit's best rows go on.

Defined results: vectors that are null or hold null or non-finite components
take no part; shorter vectors count as padded with zeros; rows that share the
query's id are its own rows and no candidates; repeated rows are candidates of
their own, and queries of their own with a ranking each; ties go to the smaller
id; empty tables give no rows; further columns are ignored.  A component whose
integer takes more than 62 bits, or a score among the best that no long holds,
raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_bucket, stored

SCALE = 64
TOP = 20
QUERY_EVERY = 20
BLOCK_ROWS = 1 << 16
QUERY_BLOCK = 256


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, ints) of the vectors that take part."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    rows = rows.select(F.col(id_col).alias("vec_id"), v.alias("_v")).where("vec_id is not null and _v is not null")
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float(1 << 62)))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    checked = F.when(fine, F.transform("_v", lambda x: F.floor(x * scale).cast("long"))) \
        .otherwise(F.raise_error(F.lit("a component is too large for a long")).cast("array<bigint>"))
    return rows.where(finite).select("vec_id", checked.alias("ints"))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """List array to a rows x width matrix, short rows padded with zeros."""
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    at = 0
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at:at + n]
        at += n
    return out


def slices_of(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rows x dims -> (bitmaps as words, lows, bits): slices of dim d are ``bits[d]`` rows, least significant first."""
    n, dims = ints.shape
    lows = ints.min(axis=0).astype(np.int64)
    shifted = ints.astype(np.uint64) - lows.astype(np.uint64)  # modulo 2**64: right for any longs
    bits = np.array([int(x).bit_length() for x in shifted.max(axis=0)], np.int64)
    words = -(-n // 64)
    maps = np.zeros((int(bits.sum()), words * 64), np.uint8)
    row = 0
    for d in range(dims):
        for b in range(int(bits[d])):
            maps[row, :n] = (shifted[:, d] >> np.uint64(b)) & np.uint64(1)
            row += 1
    return np.packbits(maps, axis=1, bitorder="little").view(np.uint64), lows, bits


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, ints) -> blocks: block_id, n, ids, maps, lows, bits; rows of a block in id order."""
    total, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
    width = max(1, width or 0)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def block():
            i, m = np.concatenate(ids), np.concatenate(parts)
            order = np.argsort(i, kind="stable")
            maps, lows, bits = slices_of(m[order])
            return pa.RecordBatch.from_pydict({"n": [len(i)], "ids": [i[order].tobytes()], "maps": [maps.tobytes()], "lows": [lows.tobytes()], "bits": [bits.tobytes()]})

        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            parts.append(_matrix(batch.column(1), width))
            held += batch.num_rows
            if held >= block_rows:
                yield block()
                ids, parts, held = [], [], 0
        if held:
            yield block()

    blocks = max(1, -(-(total or 0) // block_rows))
    made = vectors.repartition(blocks, "vec_id").mapInArrow(build, "n long, ids binary, maps binary, lows binary, bits binary")
    return stored(made.withColumn("block_id", F.monotonically_increasing_id()), "bit-slices")


def digits(q: int) -> list[tuple[int, int]]:
    """Signed binary digits (weight, sign) of q, no two adjacent: a third of the bits on average."""
    out, w, sign = [], 0, 1 if q > 0 else -1
    q = abs(q)
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((w, d * sign))
            q -= d
        q >>= 1
        w += 1
    return out


def add_slices(maps: np.ndarray, levels: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Sum of 2**w * maps[i] over levels {w: indices}, as bit slices (least significant first)."""
    out, carried, w = [], [], 0
    top = max(levels, default=-1)
    while w <= top or carried:
        given = levels.get(w)
        stack = maps[given] if given is not None else np.zeros((0, maps.shape[1]), np.uint64)
        if carried:
            stack = np.concatenate([stack, *carried])
        carried = []
        while len(stack) > 2:
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
            odd = a ^ b
            carried.append((a & b) | (odd & c))
            odd ^= c
            stack = np.concatenate([odd, stack[3 * third:]]) if len(stack) > 3 * third else odd
        if len(stack) == 2:
            carried.append(stack[:1] & stack[1:])
            stack = stack[:1] ^ stack[1:]
        out.append(stack[0] if len(stack) else np.zeros(maps.shape[1], np.uint64))
        w += 1
    return out


def top_rows(slices: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest values among the live rows; ties to the lower position."""
    certain, maybe = np.zeros_like(live), live
    left = k
    if int(np.bitwise_count(live).sum()) <= k:
        certain, maybe = live, certain
        left = 0
    for s in reversed(slices):
        if not left:
            break
        here = maybe & s
        n = int(np.bitwise_count(here).sum())
        if n > left:
            maybe = here
        else:
            certain = certain | here
            maybe = maybe & ~s
            left -= n
    found = _positions(certain)
    if left:  # boundary rows: equal scores, first by position
        found = np.concatenate([found, _positions(maybe, left)])
    return found


def _positions(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    if most is not None and len(words) > most:
        words = words[:most]  # each word holds at least one
    bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
    row, bit = np.nonzero(bits)
    return (words[row] * 64 + bit)[:most]


class Block:
    """An index block ready to be queried."""

    def __init__(self, n: int, ids: bytes, maps: bytes, lows: bytes, bits: bytes):
        self.n, self.ids = n, np.frombuffer(ids, np.int64)
        self.lows, self.bits = np.frombuffer(lows, np.int64), np.frombuffer(bits, np.int64)
        words = -(-n // 64)
        plain = np.frombuffer(maps, np.uint64).reshape(-1, words)
        self.maps = np.concatenate([plain, ~plain])  # second half: complements
        self.first = np.concatenate([[0], np.cumsum(self.bits)])
        self.count = len(plain)
        self.live = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        levels: dict[int, list[int]] = {}
        constant = 0
        for d in np.flatnonzero(query[:len(self.bits)]):
            q, first, bits = int(query[d]), int(self.first[d]), int(self.bits[d])
            constant += q * int(self.lows[d])
            for w, sign in digits(q):
                if sign < 0:  # -x = complement(x) - (2**bits - 1)
                    constant -= ((1 << bits) - 1) << w
                for b in range(bits):
                    levels.setdefault(w + b, []).append(first + b + (self.count if sign < 0 else 0))
        slices = add_slices(self.maps, {w: np.array(x) for w, x in levels.items()})
        live = self.live
        own = np.arange(*np.searchsorted(self.ids, [query_id, query_id + 1]))
        if len(own):
            live = live.copy()
            for i in own:
                live[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        at = top_rows(slices, live, k)
        chosen = [((s[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) for s in slices]
        if len(slices) <= 62 and abs(constant) < 1 << 62:
            return self.ids[at], sum((c << w for w, c in enumerate(chosen)), np.full(len(at), constant, np.int64))
        exact = [constant + sum(int(c[i]) << w for w, c in enumerate(chosen)) for i in range(len(at))]
        if any(not -(1 << 63) <= x < 1 << 63 for x in exact):
            raise ValueError("a score is too large for a long")
        return self.ids[at], np.array(exact, np.int64)


def search(queries: DataFrame, index: DataFrame, k: int = TOP, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(vec_id, ints) x index -> query_id, rank, vec_id, score: each query's k best rows."""
    queries = stored(queries.withColumn("query_row", F.monotonically_increasing_id()), "queries")
    total, width = queries.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
    width = max(1, width or 0)
    parts = max(1, -(-(total or 0) // query_block))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ids, places = (batch.column(c).to_numpy() for c in ("part", "vec_id", "query_row"))
            m = _matrix(batch.column("ints"), width)
            for p in np.unique(part):
                mine = part == p
                yield pa.RecordBatch.from_pydict({"part": [int(p)], "query_rows": [places[mine].tobytes()], "query_ids": [ids[mine].tobytes()], "vectors": [m[mine].tobytes()]})

    dealt = queries.withColumn("part", hash_bucket(parts, "query_row")).repartition("part")  # by row: equal ids are dealt, too
    packed = dealt.select("part", "vec_id", "ints", "query_row").mapInArrow(pack, "part long, query_rows binary, query_ids binary, vectors binary")
    units = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).join(packed, "part").repartition("block_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                unit = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if unit["block_id"] != held:
                    held, block = unit["block_id"], Block(*(unit[c] for c in ("n", "ids", "maps", "lows", "bits")))
                ids = np.frombuffer(unit["query_ids"], np.int64)
                vectors = np.frombuffer(unit["vectors"], np.int64).reshape(len(ids), width)
                found = [block.search(int(q), v, k) for q, v in zip(ids, vectors, strict=True)]
                sizes = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.frombuffer(unit["query_rows"], np.int64), sizes)), pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([f[0] for f in found])),
                                                  pa.array(np.concatenate([f[1] for f in found]))], names=["query_row", "query_id", "vec_id", "score"])

    best = units.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    vectors = quantised(rows, id_col, vector_col, scale)
    return search(vectors.where(is_query), build_index(vectors), k)


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT *, row_number() OVER () AS query_row FROM v WHERE vec_id % {QUERY_EVERY} = 0),
s AS (SELECT q.query_row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM q JOIN v c ON q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}"""
