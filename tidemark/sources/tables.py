"""Readers for the driver's parquet tables and for our own page/state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import RAW_PAGE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_raw_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A fetched corpus (``RAW_PAGE`` columns, extra columns kept) from parquet or JSON lines.

    JSON is read with the declared schema, never inferred.
    """
    if fmt == "json":
        return spark.read.schema(RAW_PAGE).json(path)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_PAGE.fields],
                     *[c for c in df.columns if c not in RAW_PAGE.fieldNames()])
