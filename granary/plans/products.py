"""Load a product export into ``product_raw``, ``nutrient_100g`` and ``import_metadata``."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import catalog
from granary.operators.dedupe import (
    completeness_score,
    duplicate_keys,
    keep_best,
    keep_first,
    resolve_listed,
    row_cap,
    split_by_list,
    with_key,
)
from granary.operators.quality import (
    GateError,
    gate_duplicates,
    gate_identity,
    holds_duplicates,
    gate_unique,
    run_totals,
)
from granary.operators.reshape import nutrient_table, product_rows, product_table
from granary.session import cleans_staged, stage
from granary.sinks.events import RunLog
from granary.sinks.publication import create_published, publish
from granary.sinks.tables import append_provenance, create_database, create_table, read_table
from granary.sources.delimited import (
    MAX_CELL_CHARS,
    SOURCE_BLOCK,
    SOURCE_FILE,
    SOURCE_ORDER,
    TAB,
    InputError,
    cannot_split,
    choose_delimiter,
    read_delimited,
    read_header,
    read_header_line,
)
from granary.sources.fingerprint import combined_fingerprint, fingerprint
from granary.sources.manifest import read_code_list, read_manifest

PRODUCTS, NUTRIENTS, PROVENANCE = "product_raw", "nutrient_100g", "import_metadata"
DEDUPE = ("none", "memory", "best")


@dataclass(frozen=True)
class ProductLoad:
    """Typed rows of one export and the rows that win their code."""

    rows: DataFrame
    products: DataFrame
    nutrients: DataFrame


def source_columns(header: list[str], nutrients: str, include_salt: bool) -> list[str]:
    """Only the headers a load needs; the scan prunes the rest."""
    fixed = [catalog.PRODUCT_KEY_FIELD, *catalog.PRODUCT_TEXT_FIELDS, catalog.PRODUCT_TIME_FIELD]
    if nutrients == "all":
        return fixed + [h for h in dict.fromkeys(header) if h.endswith(catalog.NUTRIENT_SUFFIX)]
    return fixed + [f.source_field for f in catalog.nutrient_fields(include_salt)]


def rows_read(
    rows: DataFrame,
    order: tuple[str, ...],
    dedupe: str,
    codes: DataFrame | None = None,
    max_rows: int = 0,
    block: tuple[str, ...] = (SOURCE_FILE, SOURCE_BLOCK),
) -> DataFrame:
    """The rows up to and including the ``max_rows``-th that is kept without waiting for others of its
    code: the first of a code, or one of a code that is not resolved by score."""
    if not max_rows:
        return rows
    counted = with_key(rows)
    if dedupe == "memory":
        counted = keep_first(counted, "code_norm", order)
    elif dedupe == "best":
        codes = duplicate_keys(counted, "code_norm")
    if codes is not None:
        counted, _ = split_by_list(counted, codes, "code_norm")
    return row_cap(rows, counted, order, max_rows, [F.col(b) for b in block])


def resolve_rows(
    rows: DataFrame,
    order: tuple[str, ...],
    dedupe: str,
    codes: DataFrame | None = None,
    max_rows: int = 0,
    block: tuple[str, ...] = (SOURCE_FILE, SOURCE_BLOCK),
) -> DataFrame:
    """One row per code: all rows, the first, the best, or the best for listed codes only."""
    keyed = with_key(rows_read(rows, order, dedupe, codes, max_rows, block))
    score = completeness_score(F.col("emitted"))
    if dedupe == "memory":
        return keep_first(keyed, "code_norm", order)
    if dedupe == "best":
        return keep_best(keyed, "code_norm", score, order)
    if codes is None:
        return keyed
    return resolve_listed(keyed, codes, "code_norm", score, order).drop("resolved")


def load_products(
    spark: SparkSession,
    raw: DataFrame,
    *,
    nutrients: str = "minimal",
    include_salt: bool = False,
    dedupe: str = "best",
    codes: DataFrame | None = None,
    max_rows: int = 0,
    order: tuple[str, ...] = SOURCE_ORDER,
    block: tuple[str, ...] = (SOURCE_FILE, SOURCE_BLOCK),
) -> ProductLoad:
    """Typed rows, winners and long rows of raw wide text.

    Typed rows are staged once: a raw export may be one gzip file that a single task reads, and the
    source positions must not change between uses.  Winners are staged too, since two tables are
    projected from the same ones.
    """
    typed, fields, names = product_rows(raw, nutrients, include_salt, keep=order)
    rows = stage(typed, "product-rows")
    if max_rows:
        rows = stage(rows_read(rows, order, dedupe, codes, max_rows, block), "product-rows-read")
    winners = stage(resolve_rows(rows, order, dedupe, codes), "product-winners")
    return ProductLoad(rows, product_table(winners), nutrient_table(winners, fields, names))


def _resolve_path(manifest_path: str, listed: str) -> str:
    """A code list path from a manifest is relative to the manifest's folder."""
    folder, slash, _ = manifest_path.rstrip("/").rpartition("/")
    if listed.startswith("/") or ":/" in listed:
        return listed
    return f"{folder}{slash}{listed}"


@cleans_staged
def import_products(
    spark: SparkSession,
    path: str,
    database: str,
    *,
    location: str | None = None,
    delimiter: str = TAB,
    nutrients: str = "minimal",
    include_salt: bool = False,
    max_rows: int = 0,
    expected_sha256: str | None = None,
    preflight_manifest: str | None = None,
    duplicate_codes: str | None = None,
    dedupe: str = "none",
    truncate: bool = False,
    max_chars: int = MAX_CELL_CHARS,
    encoding_errors: str = "strict",
    log_path: str | None = None,
    log_format: str = "text",
) -> DataFrame:
    """Check the export against its preflight, load it, and return one row of totals.

    ``dedupe``: ``none`` refuses repeated codes unless a code list resolves them by score,
    ``memory`` keeps the first row of each code, ``best`` resolves every code by score.
    """
    if dedupe not in DEDUPE:
        raise ValueError(f"dedupe must be one of {', '.join(DEDUPE)}")
    started = time.time()
    log = RunLog(spark, log_path, log_format)
    identity = stage(combined_fingerprint(fingerprint(spark, path)), "fingerprint")
    file = identity.first()
    if file["files"] == 0:
        raise InputError(f"no input file at {path}")
    manifest = read_manifest(spark, preflight_manifest) if preflight_manifest else None
    gate_identity(identity, expected_sha256=expected_sha256, manifest=manifest)
    has_duplicates = holds_duplicates(manifest)
    if dedupe == "memory" and duplicate_codes is not None:
        raise GateError("keep the first row or give a code list, not both")
    listed = duplicate_codes
    if listed is None and manifest and manifest["duplicate_codes_path"]:
        listed = _resolve_path(preflight_manifest, manifest["duplicate_codes_path"])
    codes = stage(read_code_list(spark, listed), "codes") if listed else None
    if codes is not None and codes.isEmpty():
        codes = None
    gate_duplicates(has_duplicates, keep_first=dedupe != "none", has_codes=codes is not None)

    used, detected = choose_delimiter(read_header_line(spark, path), delimiter)
    log.event("dialect", delimiter=repr(used), detected=repr(detected))
    header = read_header(spark, path, used)
    if catalog.PRODUCT_KEY_FIELD not in header:
        raise InputError(f"{path} has no column {catalog.PRODUCT_KEY_FIELD}")
    raw = read_delimited(
        spark, path, sep=used, columns=source_columns(header, nutrients, include_salt),
        max_chars=max_chars, encoding_errors=encoding_errors, with_order=True,
    )
    if cannot_split(spark, path):
        raw = stage(raw, "product-raw")  # one task unpacks it; the written rows are cleaned by many
    load = load_products(
        spark, raw, nutrients=nutrients, include_salt=include_salt, dedupe=dedupe, codes=codes,
        max_rows=max_rows,
    )
    gate_unique(load.products, ["code_norm"], PRODUCTS)
    if nutrients == "all":
        gate_unique(load.nutrients, ["code_norm", "nutrient_key"], NUTRIENTS)

    create_database(spark, database, location)
    create_published(spark, database, {PRODUCTS: catalog.PRODUCT_SCHEMA, NUTRIENTS: catalog.NUTRIENT_SCHEMA})
    create_table(spark, database, PROVENANCE, catalog.PROVENANCE_SCHEMA)
    if not truncate:
        known = read_table(spark, database, PRODUCTS).select("code_norm")
        if not load.products.join(known, "code_norm", "left_semi").isEmpty():
            raise GateError(f"{database}.{PRODUCTS} already holds some of these codes")
    publish(spark, database, {PRODUCTS: load.products, NUTRIENTS: load.nutrients}, replace=truncate)
    append_provenance(
        spark, database, file_path=path, file_sha256=file["file_sha256"],
        file_bytes=file["file_bytes"], delimiter=used, nutrients_mode=nutrients, table=PROVENANCE,
    )
    resolved = duplicate_keys(load.rows, "code_norm") if dedupe == "best" else codes
    totals = run_totals(
        load.rows, load.products, load.nutrients, keep_first=dedupe == "memory", listed=resolved
    ).withColumn("seconds", F.lit(round(time.time() - started, 2)))
    done = spark.createDataFrame(totals.collect(), totals.schema)  # one row
    log.event("done", **done.first().asDict())
    return done
