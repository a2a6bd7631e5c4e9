"""Preference formatting for chat data (DataFrame functions only).

A pair is two conversations, chosen and rejected, as turn rows.  Their longest
common prefix of turns is rendered once as the prompt; what follows is rendered
per side as a completion, with the spans to train on (assistant text and its
end marker; headers, other roles and the prompt are masked).

Everything stays in turn rows: the result has one row per rendered turn with
its place in its part, so no conversation has to fit one task.  ``assemble``
makes one row per pair where conversations are known to be short.

Defined results: exact repeats of a turn row count once; turns that share a
number are ordered by role and text; gaps in turn numbers close up; a null turn
number comes last; null role and text render empty and equal each other; equal
conversations give a prompt only; if one side is missing the other is all
completion; columns besides those named are ignored; empty tables give an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_top, join_on, prefix_sum, stored

OPEN, HEAD, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TURNS_PER_BUCKET = 4096


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Turn rows as (conv_id, pos, role, text), pos gapless from 0."""
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).distinct()
    last = F.lit((1 << 63) - 1)
    rows = stored(rows.withColumn("turn", F.coalesce("turn", last)), "turns")
    bucket = F.expr(f"turn div {TURNS_PER_BUCKET}")
    return prefix_sum(rows.withColumn("_b", bucket), ["conv_id"], "_b", ["turn", "role", "text"], F.lit(1).cast("long"), "pos") \
        .select("conv_id", "pos", "role", "text")


def preference_turns(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(pair_id, pos, role, text) twice -> one row per rendered turn.

    Columns: pair_id, part (prompt, chosen, rejected), pos, role, rendered,
    start and length (characters, in the part), train_start and train_length
    (-1 and 0 where masked), prompt_turns.
    """
    c = chosen.select("pair_id", "pos", F.struct("role", "text").alias("c"))
    r = rejected.select(F.col("pair_id").alias("_r_pair"), F.col("pos").alias("_r_pos"), F.struct("role", "text").alias("r"))
    both = c.join(r, c.pair_id.eqNullSafe(r._r_pair) & (c.pos == r._r_pos), "full_outer")
    both = both.select(F.when(F.col("c").isNotNull(), F.col("pair_id")).otherwise(F.col("_r_pair")).alias("pair_id"),
                       F.coalesce("pos", "_r_pos").alias("pos"), "c", "r")
    both = stored(both, "preference-pairs")
    # -(first position where the sides differ); null if they never do
    marked = group_top(both, ["pair_id"], F.when(~F.col("c").eqNullSafe(F.col("r")), -F.col("pos")), F.col("pos"))
    common = F.col("top").isNull() | (F.col("pos") < -F.col("top"))
    turns = marked.select("pair_id", "pos", F.coalesce(-F.col("top"), "group_size").alias("prompt_turns"),
                          F.inline(F.filter(F.array(
                              F.struct(F.when(common, F.lit("prompt")).otherwise(F.lit("chosen")).alias("part"), F.col("c").alias("t")),
                              F.struct(F.lit("rejected").alias("part"), F.when(~common, F.col("r")).alias("t"))),
                              lambda x: x["t"].isNotNull())))
    turns = stored(turns.select("pair_id", "part", "pos", "t.role", "prompt_turns",
                                F.concat(F.lit(OPEN), "t.role", F.lit(HEAD), "t.text", F.lit(CLOSE)).alias("rendered"),
                                F.length("t.text").alias("_text")), "preference-turns")
    size = F.length("rendered").cast("long")
    placed = prefix_sum(turns.withColumn("_b", F.expr(f"pos div {TURNS_PER_BUCKET}")), ["pair_id", "part"], "_b", ["pos"], size, "start")
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return placed.select("pair_id", "part", "pos", "role", "rendered", "start", size.alias("length"),
                         F.when(trained, F.col("start") + len(OPEN + HEAD) + F.length("role")).otherwise(-1).alias("train_start"),
                         F.when(trained, F.col("_text") + len(CLOSE)).otherwise(0).cast("long").alias("train_length"), "prompt_turns")


def assemble(turns: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected and the train spans of both (short conversations)."""
    def ordered(part, col):
        rows = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("pos", col))))
        return rows
    spans = F.struct(F.col("train_start").alias("start"), F.col("train_length").alias("length")).alias("span")
    t = turns.withColumn("span", F.when(F.col("train_length") > 0, spans))
    parts = []
    for part in ("prompt", "chosen", "rejected"):
        parts.append(F.array_join(F.transform(ordered(part, "rendered"), lambda x: x["rendered"]), "").alias(part))
        if part != "prompt":
            parts.append(F.filter(F.transform(ordered(part, "span"), lambda x: x["span"]), lambda x: x.isNotNull()).alias(f"{part}_train"))
    return t.groupBy("pair_id").agg(*parts)


def swapped_reply_pairs(turns: DataFrame, trained_role: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: chosen is the conversation, rejected has its
    last assistant text replaced by that of the conversation with id XOR 1 (kept if there is none)."""
    last = turns.where(F.col("role") == trained_role).groupBy("conv_id").agg(F.max("pos").alias("pos"))
    replies = stored(join_on(turns, last, ["conv_id", "pos"]).select("conv_id", "pos", "text"), "last-replies")
    other = replies.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("text").alias("_swap"))
    swaps = replies.select("conv_id", "pos").join(other, "conv_id")
    chosen = turns.select(F.col("conv_id").alias("pair_id"), "pos", "role", "text")
    swapped = join_on(turns, swaps, ["conv_id", "pos"], "left")
    rejected = swapped.select(F.col("conv_id").alias("pair_id"), "pos", "role", F.coalesce("_swap", "text").alias("text"))
    return chosen, rejected


SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS pos, role, text
           FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
last AS (SELECT conv_id, max(pos) AS pos FROM t WHERE role = 'assistant' GROUP BY conv_id),
reply AS (SELECT t.* FROM t JOIN last USING (conv_id, pos)),
pair AS (SELECT t.conv_id AS pair_id, t.pos, t.role, t.text AS chosen, coalesce(o.text, t.text) AS rejected
         FROM t LEFT JOIN last l ON l.conv_id = t.conv_id AND l.pos = t.pos
                LEFT JOIN reply o ON l.conv_id IS NOT NULL AND o.conv_id = xor(t.conv_id, 1)),
cut AS (SELECT pair_id, coalesce(min(pos) FILTER (WHERE chosen <> rejected), count(*)) AS n FROM pair GROUP BY pair_id),
part AS (SELECT pair_id, CASE WHEN pos < n THEN 'prompt' ELSE 'chosen' END AS part, pos, role, chosen AS text, n FROM pair JOIN cut USING (pair_id)
         UNION ALL SELECT pair_id, 'rejected', pos, role, rejected, n FROM pair JOIN cut USING (pair_id) WHERE pos >= n),
done AS (SELECT *, '{OPEN}' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM part)
SELECT pair_id, part, pos, role, rendered,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       length(rendered) AS length,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + {len(OPEN + HEAD)} + length(role) ELSE -1 END AS train_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(text) + {len(CLOSE)} ELSE 0 END AS train_length,
       n AS prompt_turns
FROM done"""
