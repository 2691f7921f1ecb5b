"""A versioned target by key bucket: a batch rewrites only the buckets that it touches, and a read ranks nothing.

Rows live in ``data/version=V/bucket=B``.  A head (``heads/version=V``) names, for every bucket that has rows, the
version that holds them; it is one small file, written after the data, so it is what commits a batch.  A
reader takes the newest head and sees the rows of one version of every bucket, never of half a batch.
A batch that is replayed merges with the head before its own and overwrites its own folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.dedupe import keep_best
from granary.session import stage
from granary.streaming.incremental import run_batches, run_name

VERSION, BUCKET = "version", "bucket"
#: Buckets of a new target; a head has at most as many rows.
BUCKETS = 256
_AGE = "_age"
_HEAD = f"{BUCKET} int, holder string"


def _folder(target: str, kind: str, version: str) -> str:
    return f"{target.rstrip('/')}/{kind}/{VERSION}={version}"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_head(spark: SparkSession, target: str, before: str | None = None) -> dict[int, str]:
    """The version that holds each bucket, by the newest head (older than ``before``)."""
    schema = T.StructType([*T.StructType.fromDDL(_HEAD).fields, T.StructField(VERSION, T.StringType())])
    heads = spark.read.schema(schema).parquet(f"{target.rstrip('/')}/heads")
    if before is not None:
        heads = heads.where(F.col(VERSION) < before)
    newest = heads.agg(F.max(VERSION)).first()[0]
    rows = heads.where(F.col(VERSION) == newest).collect() if newest is not None else []  # one row per bucket
    return {r[BUCKET]: r["holder"] for r in rows if r[BUCKET] is not None}


def read_buckets(
    spark: SparkSession, target: str, schema: T.StructType, head: dict[int, str] | None = None, only: Sequence[int] | None = None
) -> DataFrame:
    """The current rows, one per key; with ``only`` those of some buckets.  No other file is opened."""
    head = read_head(spark, target) if head is None else head
    held = sorted((b, v) for b, v in head.items() if only is None or b in set(only))
    if not held:
        return spark.createDataFrame([], schema)
    paths = [f"{_folder(target, 'data', v)}/{BUCKET}={b}" for b, v in held]
    return spark.read.schema(schema).parquet(*paths)


def _write(target: str, rows: DataFrame, touched: Sequence[int], head: dict[int, str], version: str) -> None:
    spark = rows.sparkSession
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(_folder(target, "data", version))
    new = sorted(({**head, **dict.fromkeys(touched, version)}).items())
    # A head of no bucket has one empty row, so that it is there.
    spark.createDataFrame(new or [(None, None)], _HEAD).coalesce(1).write.mode("overwrite").parquet(_folder(target, "heads", version))


def _create(spark: SparkSession, target: str) -> None:
    empty = spark.createDataFrame([(None, None)], _HEAD)
    empty.coalesce(1).write.mode("ignore").parquet(_folder(target, "heads", "0"))


def merge_batch(
    batch: DataFrame, target: str, version: str, key: str, rows: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS
) -> list[int]:
    """Replace the buckets of the keys in ``batch`` by ``rows(batch, current rows of these buckets)``; returns them.

    Versions sort by time; ``buckets`` must be that of the target.  A null key is a key like any other.
    """
    spark, schema = batch.sparkSession, batch.schema
    _create(spark, target)
    batch = stage(batch, "bucket-batch")  # read twice; a replay finds the same rows
    touched = sorted(r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect())  # one number per bucket
    head = read_head(spark, target, before=version)
    merged = rows(batch, read_buckets(spark, target, schema, head, touched)).select(*schema.names)
    _write(target, merged.withColumn(BUCKET, bucket_of(key, buckets)), touched, head, version)
    return touched


def best_rows(key: str, score: Sequence[Column], order: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The best row of each key among current and new ones; a current one wins a tie, then the earliest."""

    def merged(batch: DataFrame, current: DataFrame) -> DataFrame:
        aged = current.withColumn(_AGE, F.lit(0)).unionByName(batch.withColumn(_AGE, F.lit(1)))
        return keep_best(aged, key, score, (_AGE, *order)).drop(_AGE)

    return merged


def upsert_buckets(
    stream: DataFrame, target: str, key: str, checkpoint: str, score: Sequence[Column], order: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Merge every available batch of a stream into the target, then stop."""
    run = run_name(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, target, f"{run}-{batch_id:012d}", key, best_rows(key, score, order), buckets)

    run_batches(stream, checkpoint, write)
