"""Helpers of the llm operators: table access, stored intermediates, two-level prefix sums and group maxima."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that no later result reads."""
    for t in tables:
        jvm, jsc = t.sparkSession._jvm, t.sparkSession.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on equally named columns; the right side's copies are dropped."""
    ren = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(ren[f"_r_{c}"])
    return left.join(ren, cond, how).drop(*[f"_r_{c}" for c in cols])


def hot_keys(counted: DataFrame, count_col: str, total: int, most: int = 1024) -> DataFrame:
    """Rows of a table of counts by key that hold more than 1 / ``most`` of ``total``: fewer than ``most`` rows, whatever the data."""
    return counted.where(F.col(count_col) * F.lit(most) > F.lit(total))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, row: list[str], how: str = "inner", salts: int = 64) -> DataFrame:
    """Equi-join that deals the left rows of ``hot`` keys (see :func:`hot_keys`) over ``salts`` sub-keys by ``row``; right rows are repeated there."""
    mark = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*row), F.lit(salts)).cast("int")).otherwise(0)
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(mark, keys, "left").withColumn("_salt", salt).drop("_hot")
    copied = right.join(mark, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def prefix_sum(df: DataFrame, keys: list[str], bucket: str, order: list, value: Column, out: str) -> DataFrame:
    """Exclusive prefix sum of ``value`` within ``keys`` in the order (bucket, order).

    Two levels, so that no key is handled by one task: running sums inside
    each (keys, bucket), and the sums of earlier buckets from a small table of
    bucket totals.  ``df`` is read twice; store it first if it is not cheap.
    """
    df = df.withColumn("_v", value)
    here = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_run", F.sum("_v").over(here) - F.col("_v"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(F.sum("_v").alias("_total"))
    offsets = totals.select(*keys, bucket, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_off"))
    joined = join_on(local, offsets, [*keys, bucket])
    return joined.withColumn(out, F.col("_run") + F.col("_off")).drop("_v", "_run", "_off")


def group_top(df: DataFrame, keys: list[str], value: Column, row: Column, salts: int = 64) -> DataFrame:
    """Each row with its group's largest value (``top``) and size (``group_size``).

    A group's rows are dealt over ``salts`` sub-groups by a hash of ``row``;
    sub-groups are aggregated, then the groups, and the result goes back the
    same way, so a group of any size never meets in one task.
    """
    df = df.withColumn("_value", value).withColumn("_salt", F.pmod(F.xxhash64(row), F.lit(salts)))
    parts = df.groupBy(*keys, "_salt").agg(F.max("_value").alias("_top"), F.count(F.lit(1)).alias("_n"))
    whole = parts.groupBy(*keys).agg(F.max("_top").alias("top"), F.sum("_n").alias("group_size"))
    spread = join_on(parts.select(*keys, "_salt"), whole, keys)
    return join_on(df, spread, [*keys, "_salt"]).drop("_value", "_salt")


def hash_bucket(buckets: int, *cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


#: ASCII letters for translate(): the contracts lower-case A-Z only.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


#: Word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
