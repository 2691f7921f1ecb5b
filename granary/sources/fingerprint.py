"""SHA-256 and size of files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.sources.files import list_files

CHUNK_BYTES = 1024 * 1024  # fixed value: read size of the streamed hash
FINGERPRINT_SCHEMA = "path string, file_sha256 string, file_bytes long"
#: Names of Spark's connectors under which Arrow knows the same store.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _location(path: str) -> str:
    """A path as Arrow wants it: its own names of stores, and two slashes more than Spark prints for local files."""
    scheme, rest = path.split(":", 1)
    return f"{_SCHEMES.get(scheme, scheme)}://{re.sub('^/+', '/', rest) if scheme == 'file' else rest.removeprefix('//')}"


def file_digest(path: str) -> tuple[str, int]:
    """SHA-256 and size of a file, read chunk by chunk."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(_location(path))
    digest, size = hashlib.sha256(), 0
    with system.open_input_stream(name, buffer_size=CHUNK_BYTES) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            digest.update(chunk)
            size += len(chunk)
    return digest.hexdigest(), size


def fingerprint(spark: SparkSession, path: str | Sequence[str], *, glob: str = "*") -> DataFrame:
    """``(path, file_sha256, file_bytes)`` per file.

    A SHA-256 cannot be split, so a task streams each file in constant memory, whatever its size; tasks share the
    files.  The store must be one that Arrow opens (local, HDFS, S3, GCS), for files of any size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0)
            digests, sizes = zip(*map(file_digest, paths.to_pylist()), strict=True) if len(paths) else ((), ())
            arrays = [paths, pa.array(digests, type=pa.string()), pa.array(sizes, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "file_sha256", "file_bytes"])

    return list_files(spark, path, glob).select("path").repartition("path").mapInArrow(run, FINGERPRINT_SCHEMA)


def combined_fingerprint(files: DataFrame) -> DataFrame:
    """One row for an input of one or more files: ``file_sha256``, ``file_bytes``, ``files``.

    One file keeps its own digest; several give the digest of their digests in path order.
    """
    digests = F.array_sort(F.collect_list(F.struct("path", "file_sha256")))["file_sha256"]
    total = files.agg(
        digests.alias("digests"), F.sum("file_bytes").alias("file_bytes"), F.count("*").alias("files")
    )
    joined = F.sha2(F.array_join("digests", "\n"), 256)
    return total.select(
        F.when(F.col("files") == 1, F.col("digests")[0]).otherwise(joined).alias("file_sha256"),
        "file_bytes",
        "files",
    )
