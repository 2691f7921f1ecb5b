"""Incremental loads with Structured Streaming.

A target is a folder of Parquet files with one sub-folder per run and micro-batch.  A batch writes
only its own sub-folder and overwrites it when Spark replays the batch, so a load is exactly-once
without a transaction log, costs as much as the batch and never rewrites older rows.  Streaming
state stays empty: what is already loaded is known from the target, by the key filters of its folders first.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.dedupe import keep_best, keep_first
from granary.session import stage, staged_folders
from granary.streaming.keyfilters import BATCH, RUN, Folder, prepare_filters, suspects, write_filter

VERSION = (RUN, BATCH)
NO_RUN = "0"
_FOLDER = re.compile(rf"/{RUN}=([^/]+)/{BATCH}=(-?\d+)/[^/]+$")


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType
) -> DataFrame:
    """Parquet files that arrive in a folder, each read once per checkpoint; all that are there when a
    load starts are one batch, so which row of a key comes first does not depend on a batch size."""
    return spark.readStream.schema(schema).parquet(path)


def _target_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
    )


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """A name kept beside the checkpoint, so a restarted query goes on under the same one.

    Names sort by the time their checkpoint was made; a new checkpoint never reuses a folder.
    """
    path = f"{checkpoint.rstrip('/')}/run-name"
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("ignore").text(path)
    return spark.read.text(path).first()["value"]


def _prepare(spark: SparkSession, schema: T.StructType, target: str) -> None:
    """Make the target readable before the first batch."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{target.rstrip('/')}/{RUN}={NO_RUN}/{BATCH}=-1")


def read_target(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows of a target with the run and batch that wrote them."""
    return spark.read.schema(_target_schema(schema)).parquet(target)


def _folder(target: str, folder: Folder) -> str:
    return f"{target.rstrip('/')}/{RUN}={folder[0]}/{BATCH}={folder[1]}"


def written_folders(spark: SparkSession, target: str, schema: T.StructType) -> list[Folder]:
    """Run and batch of the folders of a target, by their listing; no file is opened."""
    found = map(_FOLDER.search, read_target(spark, target, schema).inputFiles())
    return sorted({(f[1], int(f[2])) for f in found if f and f[1] != NO_RUN})


def _append_batches(
    stream: DataFrame, target: str, checkpoint: str, rows: Callable[[DataFrame, list[Folder]], DataFrame],
    written: Callable[[DataFrame, Folder], None] = lambda _, __: None,
) -> None:
    """Write ``rows(batch, older folders)`` for every available batch, then stop; ``written`` sees what was written."""
    spark, schema = stream.sparkSession, stream.schema
    _prepare(spark, schema, target)
    run = run_name(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, here = batch.sparkSession, (run, batch_id)
        older = [f for f in written_folders(session, target, schema) if f[0] != run or f[1] < batch_id]
        with staged_folders(session):
            rows(batch, older).write.mode("overwrite").parquet(_folder(target, here))
        written(session.read.schema(schema).parquet(_folder(target, here)), here)

    run_batches(stream, checkpoint, write)


def run_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Call ``write`` for every available batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def new_keys(batch: DataFrame, target: str, keys: Sequence[str], older: Sequence[Folder]) -> DataFrame:
    """The rows of a batch whose key no older folder holds.

    Only folders whose filter lets a key pass are opened, and only such keys are looked up there; a batch
    that no filter lets pass opens none.
    """
    suspect, folders = suspects(batch, target, keys, older)
    if not folders:
        return batch
    held = batch.sparkSession.read.schema(batch.schema).parquet(*[_folder(target, f) for f in folders])
    # The few suspect keys are what is sent to the old rows; the old rows stay where they are.
    found = held.select(*keys).join(suspect, list(keys), "left_semi")
    return batch.join(found, list(keys), "left_anti")


def ingest_increment(
    stream: DataFrame, target: str, key: str | Sequence[str], checkpoint: str, order: Sequence[str]
) -> None:
    """Append the rows whose key is not in the target yet, the first row of each key."""
    keys = [key] if isinstance(key, str) else list(key)
    prepare_filters(stream.sparkSession, target, stream.schema, keys, (NO_RUN, -1))

    def fresh(batch: DataFrame, older: list[Folder]) -> DataFrame:
        first = stage(keep_first(batch, keys, order), "increment")  # read several times
        return new_keys(first, target, keys, older).select(*stream.columns)

    _append_batches(stream, target, checkpoint, fresh, lambda rows, folder: write_filter(rows, target, keys, folder))


def upsert_increment(
    stream: DataFrame, target: str, key: str, checkpoint: str, score: Sequence[Column],
    order: Sequence[str],
) -> None:
    """Append the best row of each key in the batch as a new version of that key."""
    _append_batches(stream, target, checkpoint, lambda b, _: keep_best(b, key, score, order))


def current_rows(
    spark: SparkSession, target: str, schema: T.StructType, key: str, score: Sequence[Column],
    order: Sequence[str],
) -> DataFrame:
    """The best version of each key over all batches; the earliest one wins a tie.

    Long rows of the same keys follow from these rows, so the two can never disagree.
    """
    versions = read_target(spark, target, schema)
    return keep_best(versions, key, score, (*VERSION, *order)).drop(*VERSION)


def compact(
    spark: SparkSession, target: str, new_target: str, schema: T.StructType, key: str,
    score: Sequence[Column], order: Sequence[str],
) -> None:
    """Write the current rows to a new target, which later batches can go on from."""
    _prepare(spark, schema, new_target)
    rows = current_rows(spark, target, schema, key, score, order)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{new_target.rstrip('/')}/{RUN}={run}/{BATCH}=0")
