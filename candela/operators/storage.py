"""Write semantics on plain Parquet: materialised steps, merges by rewrite, hash gates, scoped replacement."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.functions.scalars import row_hash, six_places


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares; on a single machine a temporary one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        base = f"/tmp/candela-{spark.sparkContext.applicationId}"
    return f"{base.rstrip('/')}/candela-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once, written to the shared folder and read again; gone when the session ends."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan of few files for work that costs much more than a shuffle of its rows: dealt out to all cores.

    A scan with at least as many partitions as the cluster has cores, as any
    large one, stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    parts = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan if parts >= cores else scan.repartition(cores)


def merged(old: DataFrame, new: DataFrame, keys: list[str], changed: Column | None = None) -> DataFrame:
    """The table after an upsert: new rows replace old ones of the same key, where ``changed`` holds; others stay.

    ``changed`` may use columns of ``old`` and ``new`` by these aliases. One
    full outer join; NULL keys match NULL keys.
    """
    names = old.columns
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}"))
    left = old.withColumn("_old", F.lit(True)).alias("old")
    right = new.select(*names).withColumn("_new", F.lit(True)).alias("new")
    joined = left.join(right, same, "full_outer")
    take_new = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.lit(True) if changed is None else changed))
    return joined.select(*[F.when(take_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in names])


def hash_gate() -> Column:
    """Rewrite a row only if its hash differs."""
    return ~F.col("old.row_hash").eqNullSafe(F.col("new.row_hash"))


def with_row_hash(rows: DataFrame, floats: list[str], others: list[str]) -> DataFrame:
    return rows.withColumn("row_hash", row_hash(*[six_places(F.col(c)) for c in floats], *[F.col(c) for c in others]))


def restated(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that exist with another hash."""
    joined = old.select(*keys, F.col("row_hash").alias("_was")).join(new, keys)
    return joined.filter(F.col("_was") != F.col("row_hash")).select(*keys)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and those new ones whose key is not there yet."""
    fresh = new.dropDuplicates(keys).join(old.select(*keys).distinct(), keys, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def first_of(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key; keys may be expressions."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def scoped_replace(old: DataFrame, new: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """The table after deleting the keys in scope and inserting the new rows."""
    return old.join(scope.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def replaced_buckets(old: DataFrame, new: DataFrame, key: str, buckets: int) -> DataFrame:
    """The table after an upsert that reads only the buckets of keys that the new rows touch; other keys stay."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    touched = F.broadcast(new.select(bucket.alias("_bucket")).distinct())  # `buckets` rows at most
    marked = old.withColumn("_bucket", bucket)
    outside = marked.join(touched, "_bucket", "left_anti").select(*old.columns)
    inside = marked.join(touched, "_bucket", "left_semi").join(new.select(key).distinct(), key, "left_anti").select(*old.columns)
    return outside.unionByName(inside).unionByName(new.select(*old.columns))


def _renamed(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


def _place(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, previous = hadoop.Path(path.rstrip("/")), hadoop.Path(f"{path.rstrip('/')}.previous")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, previous


def recovered(spark: SparkSession, path: str) -> bool:
    """Puts the last version back if a swap was broken off between its renames; whether the table exists."""
    fs, target, previous = _place(spark, path)
    if not fs.exists(target) and fs.exists(previous):
        _renamed(fs, previous, target)
    return fs.exists(target)


def swap_in(df: DataFrame, path: str) -> None:
    """Replaces a Parquet table: written beside it first, then moved into its place.

    The version before is moved aside and goes only when the new one is in
    place; ``recovered`` puts it back after a crash in between.
    """
    spark = df.sparkSession
    there = recovered(spark, path)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    fs, target, previous = _place(spark, path)
    if there:
        fs.delete(previous, True)
        _renamed(fs, target, previous)
    _renamed(fs, spark._jvm.org.apache.hadoop.fs.Path(staged), target)
    fs.delete(previous, True)


def latest_ledger(ledger: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest entry of each key of an append-only ledger."""
    return first_of(ledger, [F.col(k) for k in keys], [F.col(order).desc()])
