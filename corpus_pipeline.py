"""Corpus pipeline: five stages over ``documents``, each by an operator of tidemark.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of documents.  Rows are told apart by two hashes of all their columns in
which a null counts as a value of its own, so null or repeated ids and further
columns, whatever their names, do no harm; rows equal in every column are one row
with its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import block_naming, jaccard, mixing, packing, toxicity
from tidemark.llm.common import stored, table

#: No SQL: toxicity is a trained model and packing a combinatorial plan; tests/llm hold the stages against plain versions.
ORACLE_SQL = None

def _fresh(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, with underscores before them as long as a column has that name."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name = "_" + name
        taken.add(name)
        out.append(name)
    return tuple(out)


def _value(docs: DataFrame, name: str) -> Column:
    """A column as something whose hash sees every null in it."""
    col = F.col(f"`{name}`")
    return col if isinstance(docs.schema[name].dataType, T.AtomicType) else F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})


def _keyed(docs: DataFrame) -> tuple[DataFrame, tuple[str, str]]:
    """With two independent hashes of the whole row, and their names: rows that agree in both are equal."""
    key = _fresh(docs, "_key1", "_key2")
    cols = [x for c in docs.columns for x in (F.isnull(F.col(f"`{c}`")), _value(docs, c))]
    return docs.withColumns({key[0]: F.xxhash64(*cols), key[1]: F.xxhash64(F.lit(1), *cols)}), key


def _plain(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows with the given keys, one of each."""
    keyed, key = _keyed(docs)
    return keyed.join(keys, list(key)).dropDuplicates(list(key)).select(*_plain(docs))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    (score,) = _fresh(docs, "_toxicity")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score_documents(docs, chain, carry=tuple(docs.columns), score_col=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*_plain(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id."""
    keyed, key = _keyed(docs)
    found = block_naming.exact_duplicates(keyed, carry=key)
    return _only(docs, found.where("kept").select(*key))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram links connect the one with the smallest doc_id; texts without words stay."""
    keyed, key = _keyed(docs)
    found = stored(jaccard.link_components(keyed, carry=key), "near-copies")
    first = found.where("comp is not null").groupBy("comp").agg(F.min(F.struct("doc_id", *key)).alias("k")).select(*[F.col(f"k.{c}") for c in key])
    return _only(docs, first.union(found.where("comp is null").select(*key)).distinct())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as systematic sampling takes it."""
    keyed, key = _keyed(docs)
    times, copy = _fresh(keyed, "_times", "_copy")
    taken = mixing.mix(keyed, carry=key).where("copies > 0").groupBy(*key).agg(F.sum("copies").cast("int").alias(times))
    rows = keyed.join(taken, list(key)).dropDuplicates(list(key))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*_plain(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", without_toxic), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies),
          ("mixing to target weights", mixed), ("best-two-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
