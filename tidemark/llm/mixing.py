"""Mixing sources to target weights by systematic sampling (DataFrame functions).

Sources in code-point order (null last) take the weights in turn.  Targets
share the words of the whole corpus by weight; a target stops at ``most_copies``
times its source's size and the excess is shared by weight among the others.
Each document of a source is expected ``target / source size`` times.  The
expected copies are summed along the source in size order, the source's offset
is added, and a document is emitted once per integer boundary its share crosses.
Sums are integers in units of 2**-24 copies, so reruns and engines agree.

Defined results: a null text has size 0; a null source is a source of its own;
rows of size 0 are taken like others (their words count 0); a source without
words has target 0 and takes nothing; repeated rows are rows of their own; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_on, prefix_sum, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    One row per source: water-filling in closed form.  In the order of
    source_size / weight the first sources are full; the rest share what is
    left by weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long")
    s = sizes.withColumn("weight", weight)
    fill = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    up_to = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (s.withColumn("_total", F.sum("source_size").over(every))
         .withColumn("_full", F.coalesce(F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most_copies)
         .withColumn("_open", F.sum("weight").over(every) - F.sum("weight").over(up_to) + F.col("weight")))
    # full as long as an equal share by weight of what is left would overfill the source
    overfull = (F.col("_total") - F.col("_full")) * F.col("weight") >= F.col("source_size") * most_copies * F.col("_open")
    s = s.withColumn("_is_full", F.min(overfull.cast("int")).over(up_to) == 1)
    left = F.col("_total") - F.sum(F.when(F.col("_is_full"), F.col("source_size") * most_copies).otherwise(0)).over(every)
    open_weight = F.sum(F.when(F.col("_is_full"), 0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("_is_full"), (F.col("source_size") * most_copies).cast("double")) \
        .otherwise(left.cast("double") * F.col("weight") / open_weight)
    return s.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, seed: int = 0,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: row_id, doc_id, source, size, source_size, target, copies, taken and ``carry``."""
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"),
                              F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *carry), "mix-sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_copies)
    rate = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 6), 16, 10).cast("long")
    plan = stored(targets.withColumn("rate", rate).withColumn("offset", offset), "mix-targets")
    # order along the source: size class (top 5 bits of the size), a hash of the id, then size and id
    bits = F.length(F.bin("size"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    bucket = (bits * 32 + F.expr("shiftright(size, greatest(length(bin(size)) - 5, 0))")) * 256 + F.conv(F.substring(digest, 1, 2), 16, 10).cast("long")
    placed = prefix_sum(rows.withColumn("bucket", bucket), ["source"], "bucket", ["size", "doc_id", "row_id"], F.lit(1).cast("long"), "position")
    mixed = join_on(placed, F.broadcast(plan) if _few(plan) else plan, ["source"])
    before = F.expr(f"(position * rate + offset) div {UNIT}")
    after = F.expr(f"((position + 1) * rate + offset) div {UNIT}")
    copies = (after - before).cast("int")
    return mixed.select("row_id", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                        (copies * F.col("size")).alias("taken"), *carry)


#: A table of targets up to so many rows is broadcast; a larger one is joined by shuffle.
FEW_SOURCES = 100_000


def _few(plan: DataFrame) -> bool:
    return plan.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def sql(docs: str, seed: int = 0) -> str:
    """DuckDB SQL for ``mix`` over a view with doc_id, text, source (unique ids; weights and limit as above)."""
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM {docs}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)}] AS w FROM d GROUP BY source),
f AS (SELECT *, sum(source_size) OVER () AS total, source_size / w AS ratio,
             coalesce(sum(source_size) OVER (ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {MOST_COPIES} AS used,
             sum(w) OVER () - sum(w) OVER (ORDER BY source_size / w, source IS NULL, source ROWS UNBOUNDED PRECEDING) + w AS open FROM s),
g AS (SELECT *, bool_and((total - used) * w >= source_size * {MOST_COPIES} * open) OVER (ORDER BY ratio, source IS NULL, source ROWS UNBOUNDED PRECEDING) AS filled FROM f),
h AS (SELECT source, source_size, CASE WHEN filled THEN CAST(source_size * {MOST_COPIES} AS DOUBLE) ELSE
             CAST(total - sum(CASE WHEN filled THEN source_size * {MOST_COPIES} ELSE 0 END) OVER () AS DOUBLE) * w
             / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target FROM g),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target / source_size * {UNIT}) AS BIGINT) ELSE 0 END AS rate,
             CAST('0x' || substr(md5('{seed}:' || coalesce(source, '')), 1, 6) AS BIGINT) AS off FROM h),
o AS (SELECT d.doc_id, d.source, d.size, row_number() OVER (PARTITION BY source ORDER BY
             (length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0))) * 256
             + CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS BIGINT), size, doc_id) - 1 AS i FROM d)
SELECT o.doc_id, o.size, p.source_size, p.target,
       CAST((((i + 1) * rate + off) // {UNIT} - (i * rate + off) // {UNIT}) * o.size AS BIGINT) AS taken
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source"""
