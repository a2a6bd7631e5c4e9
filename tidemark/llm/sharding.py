"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in logical partitions.  How many rows go from partition p to shard s
is drawn exactly: row p of the matrix is multivariate hypergeometric in what
the shards still lack.  Each partition permutes its rows and deals them by its
row of the matrix; after the exchange each shard permutes again.  Every
assignment with shard sizes at most one apart is equally likely, and the seed
fixes it.

Only the matrix (``partitions`` x shards counts) is made on the driver; its
size does not depend on the data.  Permuting is sorting by a seeded hash, in
two levels (hash bucket, then hash), so no shard meets in one task.

Defined results: null text is empty (size 1, crc 0); null ids and repeated
rows are rows like others; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bucket, prefix_sum, stored

SHARDS = 16
PARTITIONS = 1024
#: Buckets in which the rows of a partition, or with 16 times as many of a shard, are ordered at least, and the rows that a bucket should hold.
SUB_BUCKETS, BUCKET_ROWS = 64, 1 << 20


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Successes among ``draws`` without replacement; any population size (numpy stops at 1e9)."""
    if min(good, draws) == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    mode = (draws + 1) * (good + 1) // (total + 2)
    spread = math.sqrt(max(1.0, draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)))
    low, high = max(0, draws - bad, int(mode - 12 * spread)), min(good, draws, int(mode + 12 * spread) + 1)
    k = np.arange(low, high, dtype=np.float64)
    # P(k+1)/P(k); beyond 12 standard deviations the mass is below 1e-30
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_p = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.exp(log_p - log_p.max())
    return int(low + np.searchsorted(np.cumsum(p), rng.random() * p.sum(), side="right"))


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each partition to each shard; column sums are at most one apart."""
    rng, total = np.random.default_rng(seed), sum(counts)
    lack = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        rest, pool = n, sum(lack)
        for s in range(shards):
            if s == shards - 1:
                x = rest
            else:
                pool -= lack[s]
                x = hypergeometric(rng, lack[s], pool, rest)
            out[p, s] = x
            rest -= x
        lack = [a - int(b) for a, b in zip(lack, out[p], strict=True)]
    return out


def shard_rows(rows: DataFrame, key_cols: list[str], shards: int = SHARDS, partitions: int = PARTITIONS, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (a place in the shard, gapless from 0).

    ``key_cols`` tell rows apart; rows that agree in all of them are interchangeable.
    ``rows`` is read several times: pass narrow, stored rows.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("_p", hash_bucket(partitions, F.lit(seed), *key_cols))
    counts = [0] * partitions
    for r in placed.groupBy("_p").count().collect():  # at most ``partitions`` rows
        counts[r["_p"]] = r["count"]
    cuts = np.concatenate([np.zeros((partitions, 1), np.int64), np.cumsum(communication_matrix(counts, shards, seed), axis=1)], axis=1)
    matrix = spark.createDataFrame([(p, [int(x) for x in cuts[p, 1:]]) for p in range(partitions)], "_p int, _cuts array<long>")
    first = F.xxhash64(F.lit(seed + 1), *key_cols)
    subs = max(SUB_BUCKETS, max(counts) // BUCKET_ROWS)
    ranked = placed.withColumn("_h", first).withColumn("_sub", F.pmod(F.col("_h"), F.lit(subs)).cast("int"))
    ranked = prefix_sum(ranked, ["_p"], "_sub", ["_h", *key_cols], F.lit(1).cast("long"), "_i")
    dealt = (ranked.join(F.broadcast(matrix), "_p")  # bounded: partitions x shards
             .withColumn("shard", F.size(F.filter("_cuts", lambda c: c <= F.col("_i"))))
             .withColumn("_g", F.xxhash64(F.lit(seed + 2), *key_cols)).drop("_h", "_sub", "_i", "_cuts", "_p"))
    subs = max(SUB_BUCKETS * 16, sum(counts) // shards // BUCKET_ROWS)
    dealt = stored(dealt.withColumn("_sub", F.pmod(F.col("_g"), F.lit(subs)).cast("int")), "sharded")
    return prefix_sum(dealt, ["shard"], "_sub", ["_g", *key_cols], F.lit(1).cast("long"), "slot").drop("_g", "_sub")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                    partitions: int = PARTITIONS, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(F.encode(text, "utf-8")).alias("text_crc32")), "shard-rows")
    out = shard_rows(rows, ["doc_id", "size", "text_crc32"], shards, partitions, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents in folders shard=s, each file in slot order (ids must be unique)."""
    moved = docs.join(assigned.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col)
    moved.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
