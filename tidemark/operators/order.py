"""Change rows in document order, numbered per site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .diff import pack_hash, unpack_hash
from .discover import _LevelStore, number_within


def diff_ordered(changes: DataFrame) -> DataFrame:
    """``start_url, seq`` (from 1) and the change columns: current-run changes in crawl order, then removals.

    Numbered by range partitions and offsets, so no site is sorted in one task;
    hashes of the rows' own texts are neither shuffled nor stored meanwhile.
    """
    key = ("change_side", "pos_seq", "pos_order", "chunk_id")
    numbered = unpack_hash(number_within(pack_hash(changes, True), "start_url", key, _LevelStore(changes.sparkSession)), True)
    return numbered.select("start_url", F.col("_rn").cast("long").alias("seq"), "change_type", "chunk_id", "url", "heading_path", "text", "chunk_hash")
