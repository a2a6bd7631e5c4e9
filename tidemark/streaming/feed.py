"""Continuous change tracking over a feed of fetched pages.

A Structured Streaming file source watches a folder where crawlers drop
fetched pages (parquet, ``RAW_PAGE`` columns plus ``start_url``, ``page_seq``
and the crawl's ``run_at``).  A site's crawl may arrive in any number of files
and micro-batches, in any order: pages are staged by run and site, and the diff
job runs for a site once its end mark (a row with ``end_of_crawl`` true, no page
and ``page_count``) and as many pages as the mark says have come.  How the files
fall into micro-batches therefore never changes a result.  A mark without a
count ends the crawl with the pages that have come.

Pages of a run that was diffed already are kept in ``late`` and reported there,
never diffed as if they were the whole site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import RAW_PAGE
from ..plans.jobs import run_diff_job
from ..sources.site_runs import _fs, _names, exists, site_bucket
from ..sources.state import Snapshots

_PAGE_FIELDS = [T.StructField(f.name, f.dataType, True) for f in RAW_PAGE.fields]
FEED_SCHEMA = T.StructType([T.StructField("start_url", T.StringType(), False), T.StructField("run_at", T.StringType(), False),
                            T.StructField("end_of_crawl", T.BooleanType(), True), T.StructField("page_seq", T.LongType(), True), *_PAGE_FIELDS,
                            T.StructField("page_count", T.LongType(), True)])
_STAGED = T.StructType([f for f in FEED_SCHEMA.fields if f.name != "run_at"])
CRAWL = ["start_url", "run_at"]


def _is_mark():
    return F.coalesce(F.col("end_of_crawl"), F.lit(False))


class Staging:
    """Pages and marks of crawls that have not ended: ``run=<run>/site_bucket=<b>/batch=<id>`` below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """A re-executed batch replaces its own rows."""
        (batch.withColumn("run", F.col("run_at")).withColumn("site_bucket", site_bucket()).withColumn("batch", F.lit(batch_id)).drop("run_at")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "site_bucket", "batch").parquet(self.path))

    def rows(self) -> DataFrame:
        schema = T.StructType([*_STAGED.fields, T.StructField("run", T.StringType()), T.StructField("site_bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.path).withColumnRenamed("run", "run_at")

    def ended(self, done: DataFrame) -> DataFrame:
        """``start_url, run_at`` of staged crawls whose mark and pages are there, but not those of ``done``.

        A page that was dropped twice (same place in the crawl) counts once.
        """
        rows = self.rows()
        marks = rows.where(_is_mark()).groupBy(*CRAWL).agg(F.max("page_count").alias("want"))
        pages = rows.where(~_is_mark()).groupBy(*CRAWL, "page_seq").agg(F.lit(1).alias("one")).groupBy(*CRAWL).agg(F.count("one").alias("have"))
        full = marks.join(pages, CRAWL, "left").where(F.coalesce("have", F.lit(0)) >= F.coalesce("want", F.lit(0)))
        return full.select(*CRAWL).join(done, CRAWL, "left_anti")

    def crawl(self, run_at: str, sites: DataFrame) -> DataFrame:
        """The pages of ended crawls of a run; of a page dropped twice the later batch's."""
        pages = self.rows().where((F.col("run_at") == run_at) & ~_is_mark()).join(sites, "start_url", "left_semi")
        last = pages.groupBy("start_url", "page_seq").agg(F.max("batch").alias("batch"))
        return pages.join(last, ["start_url", "page_seq", "batch"]).dropDuplicates(["start_url", "page_seq"]).drop("batch", "run_at", "site_bucket", "end_of_crawl", "page_count")

    def late(self, done: DataFrame, batch_id: int) -> DataFrame:
        """Pages of this batch whose crawl was diffed before."""
        return self.rows().where((F.col("batch") == batch_id) & ~_is_mark()).join(done, CRAWL, "left_semi")

    def clean(self, done: DataFrame) -> None:
        """Delete the folders in which every crawl is done; their list is bounded by open runs times buckets."""
        open_ = self.rows().select(*CRAWL, "site_bucket").distinct().join(done.withColumn("_done", F.lit(True)), CRAWL, "left")
        finished = open_.groupBy("run_at", "site_bucket").agg(F.bool_and(F.coalesce("_done", F.lit(False))).alias("all")).where("all").collect()
        gone = {(r["run_at"], r["site_bucket"]) for r in finished}
        for folder in _names(self.spark, self.path):
            run = _unescaped(folder.removeprefix("run="))
            for inner in _names(self.spark, f"{self.path}/{folder}") if folder.startswith("run=") else []:
                if (run, int(inner.removeprefix("site_bucket="))) in gone:
                    fs, p = _fs(self.spark, f"{self.path}/{folder}/{inner}")
                    fs.delete(p, True)


def _unescaped(name: str) -> str:
    """A partition value from its folder name."""
    from urllib.parse import unquote

    return unquote(name)


def start_diff_stream(spark: SparkSession, feed_dir: str, state_path: str, out_dir: str, checkpoint_dir: str, *,
                      available_now: bool = False, processing_time: str | None = None, max_files_per_trigger: int | None = None):
    """Start the stream; the crawls that a micro-batch completes are diffed, those of one run together.

    Pages wait in ``state_path/crawl``, their folders go once all their crawls are diffed; late pages are kept in
    ``out_dir/late``.  Output goes to ``out_dir/batch=<id>/run_at=<run>``; ``run_at`` must grow from crawl to crawl of a site.
    """
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    feed = reader.parquet(feed_dir)
    staged, out = f"{state_path.rstrip('/')}/crawl", out_dir.rstrip("/")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        staging, state = Staging(session, staged), Snapshots(session, state_path)
        staging.add(batch, batch_id)
        if not exists(session, staged):
            return
        done = state.runs.manifest().select(*CRAWL)
        staging.late(done, batch_id).write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        ended = staging.ended(done)
        # crawls that end together are usually one run; the distinct run marks of a batch are few
        for row in ended.select("run_at").distinct().orderBy("run_at").collect():
            sites = ended.where(F.col("run_at") == row.run_at).select("start_url")
            run_diff_job(session, staging.crawl(row.run_at, sites), state_path, f"{out}/batch={batch_id}/run_at={row.run_at}", row.run_at, sites)
        staging.clean(Snapshots(session, state_path).runs.manifest().select(*CRAWL))

    writer = feed.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
