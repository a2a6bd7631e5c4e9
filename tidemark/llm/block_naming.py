"""Exact dedup by deterministic block naming (DataFrame functions only).

The normalised text is cut into blocks of fixed size.  Blocks are sorted by
(hash, content) into integer names: the hash's high bits, and in the low bits
the rank among distinct blocks that share them, so two blocks have one name
exactly if they are equal.  Then adjacent pairs of names are named the same
way, level by level, until every document has one name.  Documents are equal
exactly if level, length and name are equal; no fingerprint is trusted.

Defined results: a null text counts as empty; empty texts are equal; a null id
ranks below all ids; of rows that agree in id and text one stays, the others
are its copies; an empty table gives an empty table; columns besides id and
text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, discard, group_top, join_on, stored

BLOCK_BYTES = 1024
RANK_BITS = 8


def _named(rows: DataFrame, content: Column, rank_bits: int, hash_mask: int) -> DataFrame:
    """``rows`` (already stored) with an integer ``name`` for ``content``, equal exactly for equal contents."""
    low = (1 << rank_bits) - 1
    high = F.xxhash64(content).bitwiseAND(F.lit(hash_mask & ~low))
    rows = rows.withColumn("_content", content).withColumn("_high", high)
    # map-side combined, so a block that a third of the rows share is one row per task
    spans = rows.groupBy("_high").agg(F.min("_content").alias("_lo"), F.max("_content").alias("_hi"))
    shared = spans.where("_lo <> _hi").select("_high")
    if shared.isEmpty():
        return rows.withColumn("name", F.col("_high")).drop("_content", "_high")
    ranks = (rows.join(shared, "_high", "left_semi").select("_high", "_content").distinct()
             .withColumn("_rank", F.row_number().over(Window.partitionBy("_high").orderBy("_content")) - 1)
             .withColumn("_rank", F.when(F.col("_rank") <= low, F.col("_rank"))
                         .otherwise(F.raise_error(F.lit("more blocks share a hash than rank_bits can number")).cast("int"))))
    return (join_on(rows, ranks, ["_high", "_content"], "left")
            .withColumn("name", F.col("_high") + F.coalesce("_rank", F.lit(0))).drop("_content", "_high", "_rank"))


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                   rank_bits: int = RANK_BITS, hash_mask: int = -1, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: row_id, doc_id, n_bytes, text_sha256, level, name and the columns of ``carry``."""
    heads = ["doc_id", *carry]
    text = docs.select(F.col(id_col).alias("doc_id"), *carry, ascii_lower(F.coalesce(text_col, F.lit(""))).alias("_t"))
    raw = text.select(*heads, F.encode("_t", "utf-8").alias("_b"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n_bytes") / block_bytes), F.lit(1)).cast("int") - 1),
                      lambda i: F.substring("_b", i * block_bytes + 1, F.lit(block_bytes)))
    rows = (raw.select(F.monotonically_increasing_id().alias("row_id"), *heads, F.octet_length("_b").cast("long").alias("n_bytes"),
                       F.sha2("_b", 256).alias("text_sha256"), "_b")
            .withColumn("_blocks", cut)
            .select("row_id", *heads, "n_bytes", "text_sha256", F.size("_blocks").alias("n"), F.posexplode("_blocks").alias("pos", "block")))
    first = F.col("pos") == 0
    level0 = stored(rows.select("row_id", "pos", "n", "block", *[F.when(first, F.col(c)).alias(c) for c in (*heads, "n_bytes", "text_sha256")]),
                    "block-level0")
    first_rows = stored(level0.where("pos = 0").select("row_id", *heads, "n_bytes", "text_sha256"), "block-documents")
    names = _named(level0.select("row_id", "pos", "n", "block"), F.col("block"), rank_bits, hash_mask).drop("block")
    done, level = [], 0
    while True:
        names = stored(names, f"block-names{level}")
        discard(level0 if not level else pairs)  # their content is named
        done.append(names.where("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        more = names.where("n > 1")
        if more.isEmpty():
            break
        even = F.col("pos") % 2 == 0
        # 0-or-1 partner: the last name of an odd row pairs with a null, kept apart by coalesce + flag
        pairs = (more.groupBy("row_id", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b")))
        pairs = stored(pairs, f"block-pairs{level}")
        both = F.struct("a", F.coalesce("b", F.lit(0)).alias("b"), F.col("b").isNull().alias("alone"))
        names = _named(pairs, both, rank_bits, hash_mask).select("row_id", "n", "pos", "name")
        level += 1
    final = done[0]
    for part in done[1:]:
        final = final.unionByName(part)
    return first_rows.join(final, "row_id")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), **kw) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row_id, n_bytes and ``carry``."""
    named = stored(name_documents(docs, id_col, text_col, carry=carry, **kw), "block-identity")
    grouped = group_top(named, ["level", "n_bytes", "name"], F.struct("doc_id", "row_id"), F.col("row_id"))
    return grouped.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
                          (F.col("top.row_id") == F.col("row_id")).alias("kept"), "text_sha256", "row_id", "n_bytes", *carry)
