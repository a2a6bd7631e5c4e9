"""Summaries, tags and embeddings for changed chunks only.

Removed chunks never reach a model: the change table is split by a filter
before the Python hook runs (Catalyst does not short-circuit a Python UDF
inside ``when``), and the removed rows get a fixed label by column
expressions.  The hooks run per Arrow batch on the executors; request and
response bodies for batch LLM jobs are plain JSON columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .deliver import UPSERT_TYPES, deletes, upserts

ENRICHED_SCHEMA = "start_url string, chunk_id string, change_type string, summary string, tags array<string>"


def path_text(col="heading_path"):
    return F.array_join(F.col(col), " > ")


def removed_labels(changes: DataFrame) -> DataFrame:
    """``Removed: a > b`` (the chunk id when the path is empty), tags ``["removed"]``."""
    label, tags = _removed()
    return deletes(changes).select("start_url", "chunk_id", "change_type", label.alias("summary"), tags.alias("tags"))


def _removed():
    """Label and tags of a removed row."""
    return F.concat(F.lit("Removed: "), F.coalesce(F.nullif(path_text(), F.lit("")), F.col("chunk_id"))), F.array(F.lit("removed"))


def enrich_prompts(changes: DataFrame) -> DataFrame:
    """User text for a changed chunk: ``[type] a > b`` + blank line + text."""
    return changes.select("start_url", "chunk_id", "change_type", F.concat(
        F.lit("["), F.col("change_type"), F.lit("] "), path_text(), F.lit("\n\n"), F.col("text")).alias("prompt"))


def enrich_requests_chat(changes: DataFrame, model: str, system_prompt: str) -> DataFrame:
    """Chat-completions request body per upsert (JSON mode, temperature 0)."""
    p = enrich_prompts(upserts(changes))
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
                F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("messages"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
        F.lit(0).alias("temperature"),
    )
    return p.select("start_url", "chunk_id", "change_type", F.to_json(body).alias("request"))


def enrich_requests_messages(changes: DataFrame, model: str, system_prompt: str,
                             max_tokens: int = 200) -> DataFrame:
    """Messages-API request body per upsert (system field, max_tokens)."""
    p = enrich_prompts(upserts(changes))
    body = F.struct(
        F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), F.lit(system_prompt).alias("system"),
        F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("messages"),
    )
    return p.select("start_url", "chunk_id", "change_type", F.to_json(body).alias("request"))


_CHAT = T.StructType([T.StructField("choices", T.ArrayType(T.StructType([
    T.StructField("message", T.StructType([T.StructField("content", T.StringType())]))])))])
_MESSAGES = T.StructType([T.StructField("content", T.ArrayType(T.StructType([
    T.StructField("text", T.StringType())])))])
_INNER = T.StructType([T.StructField("summary", T.StringType()),
                       T.StructField("tags", T.ArrayType(T.StringType()))])


def enrich_parsed(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """Parse a response of either API form into ``summary`` ('' if absent), ``tags`` ([] if absent).

    The model's answer is a JSON string inside the response.  Where it is
    not valid JSON the row keeps ``parse_error = true`` and null fields
    instead of failing the job.
    """
    r = F.col(response_col)
    chat = F.from_json(r, _CHAT)
    msgs = F.from_json(r, _MESSAGES)
    inner_text = F.coalesce(
        F.get(chat["choices"], 0)["message"]["content"],
        F.get(msgs["content"], 0)["text"],
    )
    staged = responses.select("*", inner_text.alias("_inner_text"))
    inner = F.from_json(F.col("_inner_text"), _INNER)
    valid = F.col("_inner_text").isNotNull() & F.col("_inner_text").rlike(r"^\s*\{")
    parsed = staged.select("*", F.when(valid, inner).alias("_inner"))
    ok = parsed["_inner"].isNotNull()
    return parsed.select(
        *[c for c in responses.columns],
        F.when(ok, F.coalesce(F.col("_inner.summary"), F.lit(""))).alias("summary"),
        F.when(ok, F.coalesce(F.col("_inner.tags"), F.array().cast("array<string>"))).alias("tags"),
        (~ok).alias("parse_error"),
    )


def enrich_changes(changes: DataFrame, summarizer: Callable[[dict], tuple[str, list[str]]] | None = None,
                   summarizer_factory: Callable[[], Callable[[dict], tuple[str, list[str]]]] | None = None
                   ) -> DataFrame:
    """``ENRICHED`` rows for every change; the summarizer sees added/modified rows only.

    ``summarizer(row_dict) -> (summary, tags)`` runs on the executors one
    pandas batch at a time (``mapInPandas``).  With ``summarizer_factory``
    the summarizer (and any client it holds) is built once per task instead
    of being shipped from the driver.  Removed rows get :func:`removed_labels`.
    """
    if (summarizer is None) == (summarizer_factory is None):
        raise ValueError("give exactly one of summarizer, summarizer_factory")
    cols = ["start_url", "chunk_id", "change_type", "url", "text", "chunk_hash"]
    fields = [*cols, "heading_path_text", "heading_path"]
    label, tags = _removed()
    gone = F.col("change_type") == "removed"
    # one pass over the changes: removed rows carry their label and pass the summarizer by, without their texts
    todo = changes.where(F.col("change_type").isin(*UPSERT_TYPES) | gone).select(
        *[F.when(~gone, F.col(c)).alias(c) if c in ("url", "text", "chunk_hash") else F.col(c) for c in cols],
        F.when(~gone, path_text()).alias("heading_path_text"), F.when(~gone, F.col("heading_path")).alias("heading_path"),
        F.when(gone, label).alias("_label"), F.when(gone, tags).alias("_tags"), gone.alias("_gone"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summarize = summarizer if summarizer is not None else summarizer_factory()
        for pdf in batches:
            out = iter([summarize(rec) for rec in pdf.loc[~pdf["_gone"], fields].to_dict("records")])
            out = [(label, tags) if gone else next(out) for label, tags, gone in zip(pdf["_label"], pdf["_tags"], pdf["_gone"])]
            yield pd.DataFrame({
                "start_url": pdf["start_url"], "chunk_id": pdf["chunk_id"], "change_type": pdf["change_type"],
                "summary": [s for s, _ in out], "tags": [list(t) for _, t in out],
            })

    return todo.mapInPandas(run, ENRICHED_SCHEMA)


def embed_changes(changes: DataFrame, embed: Callable[[list[str]], list[list[float]]],
                  text_col: str = "text") -> DataFrame:
    """Upserts with an ``embedding array<float>`` column; ``embed`` gets one Arrow batch of texts per call."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(texts: pd.Series) -> pd.Series:
        vecs = embed(texts.tolist())
        return pd.Series([[float(x) for x in v] for v in vecs])

    return upserts(changes).withColumn("embedding", _embed(F.col(text_col)))
