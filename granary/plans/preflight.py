"""Profile a product export before it is loaded."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import catalog
from granary.functions.text import digits_key
from granary.operators.dedupe import duplicate_keys, profile_duplicates
from granary.session import cleans_staged, stage
from granary.sinks.events import RunLog
from granary.sinks.files import write_code_list, write_manifest
from granary.sources.delimited import (
    MAX_CELL_CHARS,
    TAB,
    InputError,
    choose_delimiter,
    read_delimited,
    read_header,
    read_header_line,
)
from granary.sources.fingerprint import combined_fingerprint, fingerprint

FORMAT_VERSION = 1
SAMPLES = 20  # fixed value: default number of duplicate samples


def product_codes(
    spark: SparkSession, path: str, delimiter: str, max_chars: int, encoding_errors: str
) -> DataFrame:
    """Normalised code of every record of the export, empty ones included."""
    header = read_header(spark, path, delimiter)
    if catalog.PRODUCT_KEY_FIELD not in header:
        raise InputError(f"{path} has no column {catalog.PRODUCT_KEY_FIELD}")
    raw = read_delimited(
        spark, path, sep=delimiter, columns=[catalog.PRODUCT_KEY_FIELD], max_chars=max_chars,
        encoding_errors=encoding_errors,
    )
    return raw.select(digits_key(F.col(catalog.PRODUCT_KEY_FIELD)).alias("code_norm"))


def manifest_row(
    profile: DataFrame, duplicates: DataFrame, samples: int, literals: dict[str, Column]
) -> DataFrame:
    """The one-row manifest of a duplicate profile."""
    first = duplicates.orderBy("code").limit(samples)
    sampled = first.agg(F.array_sort(F.collect_list("code")).alias("duplicate_samples"))
    rows = profile.unionByName(sampled, allowMissingColumns=True)
    merged = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    fields = {"duplicate_codes_count": F.lit(0).cast("bigint"), **literals}
    return merged.withColumns(fields).select(*sorted(set(merged.columns) | set(fields)))


@cleans_staged
def preflight_products(
    spark: SparkSession,
    path: str,
    manifest_out: str,
    *,
    delimiter: str = TAB,
    duplicate_codes_out: str | None = None,
    duplicate_samples: int = SAMPLES,
    max_chars: int = MAX_CELL_CHARS,
    encoding_errors: str = "strict",
    log_path: str | None = None,
    log_format: str = "text",
) -> DataFrame:
    """Write the manifest (and the duplicate list) of an export; returns the manifest row."""
    file = combined_fingerprint(fingerprint(spark, path)).first()
    used, detected = choose_delimiter(read_header_line(spark, path), delimiter)
    log = RunLog(spark, log_path, log_format)
    log.event("dialect", delimiter=repr(used), detected=repr(detected))
    started = time.time()
    codes = stage(product_codes(spark, path, used, max_chars, encoding_errors), "codes")
    duplicates = stage(duplicate_keys(codes, "code_norm"), "duplicates")
    literals = {
        "format_version": F.lit(FORMAT_VERSION).cast("bigint"),
        "created_at": F.lit(time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())),
        "file_path": F.lit(path),
        "file_bytes": F.lit(file["file_bytes"]).cast("bigint"),
        "file_sha256": F.lit(file["file_sha256"]),
        "delimiter": F.lit(used),
        "detected_delimiter": F.lit(detected),
        "duplicate_codes_path": F.lit(duplicate_codes_out).cast("string"),
    }
    profile = profile_duplicates(codes, "code_norm")
    if duplicate_codes_out is not None:
        write_code_list(duplicates, duplicate_codes_out)
        literals["duplicate_codes_count"] = F.col("duplicate_values")
    manifest = manifest_row(profile, duplicates, duplicate_samples, literals)
    done = spark.createDataFrame(manifest.collect(), manifest.schema)  # one row
    done = done.withColumn("sort_seconds", F.lit(round(time.time() - started, 2)))
    write_manifest(done, manifest_out)
    row = done.first()
    log.event(
        "preflight_done", manifest=manifest_out, codes_total=row["code_total"],
        duplicates_found=row["duplicates_found"], seconds=row["sort_seconds"],
    )
    return done
