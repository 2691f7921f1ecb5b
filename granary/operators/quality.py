"""Counts, key and reference checks, reconciliation, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.catalog import Edge
from granary.functions.text import strip


class GateError(RuntimeError):
    """A load must not run."""


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Put one-row frames with different columns side by side."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


# --- counts -----------------------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` of each table, one job."""
    return _union(
        [df.agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows")
         for t, df in tables.items()]
    )


def reconcile_counts(actual: DataFrame, expected: DataFrame, source: DataFrame) -> DataFrame:
    """Compare loaded rows with the expected-count file and with a recount of the source.

    ``actual(table, rows)``, ``expected(table, expected_rows)``, ``source(table, source_rows)``.
    When more rows are loaded than expected, the expectation is stale and the source count counts.
    """
    rows = F.coalesce("rows", F.lit(0))
    stale = rows > F.col("expected_rows")
    target = F.when(stale, F.col("source_rows")).otherwise(F.col("expected_rows"))
    joined = actual.join(expected, "table", "full").join(source, "table", "full")
    return joined.select(
        "table",
        rows.alias("loaded_rows"),
        "expected_rows",
        F.when(stale, F.col("source_rows")).alias("recounted_rows"),
        F.coalesce(stale, F.lit(False)).alias("expected_rows_mismatch"),
        F.when(stale & (rows > F.col("source_rows")), "too many rows")
        .when(target.isNull(), "no expectation")
        .when((rows == target) & (rows > 0), "already loaded")
        .when(rows > 0, "partly loaded")
        .otherwise("not loaded")
        .alias("status"),
    )


# --- keys and nulls ---------------------------------------------------------------------------


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def _as_text(keys: Sequence[Column]) -> Column:
    """Key values as one array of texts: equal where the keys are, nulls included."""
    return F.array(*[k.cast("string") for k in keys])


def key_counts(tables: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[tuple[str, Sequence[Column], Column]]]) -> DataFrame:
    """``(subject, key, n)``: how often each key of each subject occurs.

    ``wanted`` names, by table, the subjects with their key columns and the condition for a row to count.  Each table is read once, whatever the
    number of its subjects, and all of them meet in one exchange of counts that were combined before it.
    """
    def one(table: str, subjects: Sequence[tuple[str, Sequence[Column], Column]]) -> DataFrame:
        rows = [F.struct(F.when(counts, name).alias("subject"), _as_text(keys).alias("key")) for name, keys, counts in subjects]
        return tables[table].select(F.inline(F.array(*rows))).where("subject IS NOT NULL")

    found = _union([one(t, subjects) for t, subjects in wanted.items() if subjects])
    return found.groupBy("subject", "key").agg(F.count("*").alias("n"))


def _with_all(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per subject, also for those that nothing was found for."""
    every = found.sparkSession.createDataFrame([(n,) for n in names], "subject string")
    return every.join(found, "subject", "left")


def check_unique(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table, key, repeated_keys, extra_rows)`` per (table name, frame, key columns)."""
    frames = {name: df for name, df, _ in checks}
    if not all(frames[name].sameSemantics(df) for name, df, _ in checks):
        raise ValueError("checks of one table name need one frame")
    wanted: dict[str, list] = {}
    for name, _, keys in checks:
        wanted.setdefault(name, []).append((f"{name}\t{','.join(keys)}", [F.col(k) for k in keys], F.lit(True)))
    repeated = key_counts(frames, wanted).where("n > 1").groupBy("subject").agg(
        F.count("*").alias("repeated_keys"), F.sum(F.col("n") - 1).alias("extra_rows")
    )
    parts = F.split("subject", "\t")
    return _with_all(repeated, [s for subjects in wanted.values() for s, *_ in subjects]).select(
        parts[0].alias("table"), parts[1].alias("key"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("repeated_keys", "extra_rows")],
    )


def check_not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table, column, null_rows)`` for each column that must be filled, one pass per table."""
    def one(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return counts.select(
            F.lit(table).alias("table"),
            F.stack(
                F.lit(len(columns)), *[x for c in columns for x in (F.lit(c), F.col(c))]
            ).alias("column", "null_rows"),
        )

    return _union([one(t, df, columns) for t, (df, columns) in tables.items()])


# --- references -------------------------------------------------------------------------------


def missing_references(
    tables: Mapping[str, DataFrame], edges: Sequence[Edge], *, ignore_null: bool = False
) -> DataFrame:
    """``(edge, missing_rows, missing_keys)`` per edge: child rows without a parent.

    A null child key counts as missing unless ``ignore_null``.  Keys are counted before they meet, so a hot
    key is one row by then; a table is read once for all edges of which it is the child, and once for those of
    which it is the parent.  Text meets a number under the number's type, by ``try_cast``.
    """
    children, parents = edge_keys(tables, edges, ignore_null)
    counted = key_counts(tables, children)
    missing = _without_parent(counted, key_counts(tables, parents)).groupBy("subject").agg(
        F.sum("n").alias("missing_rows"), F.count("*").alias("missing_keys")
    )
    return _with_all(missing, [e.name for e in edges]).select(
        F.col("subject").alias("edge"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("missing_rows", "missing_keys")]
    )


def edge_keys(tables: Mapping[str, DataFrame], edges: Sequence[Edge], ignore_null: bool) -> tuple[dict, dict]:
    """The subjects of :func:`key_counts` for the child keys and the parent keys of edges, by table."""
    children: dict[str, list] = {}
    parents: dict[str, list] = {}
    for edge in edges:
        child, parent = F.col(edge.child_key), F.col(edge.parent_key)
        counts = child.isNotNull() if ignore_null else F.lit(True)  # text that is no number counts, as missing
        child_type = tables[edge.child].schema[edge.child_key].dataType
        parent_type = tables[edge.parent].schema[edge.parent_key].dataType
        if child_type != parent_type and isinstance(parent_type, T.StringType):
            parent = parent.try_cast(child_type)
        elif child_type != parent_type:
            child = child.try_cast(parent_type)
        children.setdefault(edge.child, []).append((edge.name, [child], counts))
        parents.setdefault(edge.parent, []).append((edge.name, [parent], parent.isNotNull()))
    return children, parents


def _without_parent(counted: DataFrame, known: DataFrame) -> DataFrame:
    """Counts of child keys that no parent has; a null key has none."""
    known = known.select("subject", F.col("key")[0].alias("_parent"))
    return counted.withColumn("_child", F.col("key")[0]).join(
        known, (counted["subject"] == known["subject"]) & (F.col("_child") == F.col("_parent")), "left_anti"
    )


def table_checks(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], edges: Sequence[Edge]
) -> DataFrame:
    """``(check, subject, problems)``: rows with a repeated key, rows without a key column, child rows without
    a parent (null aside).

    Every table is read once for all of its checks, and one exchange of counted keys serves them: what
    repeats, what is null and which keys a parent has are all read off the counts.
    """
    children, parents = edge_keys(tables, edges, ignore_null=True)
    wanted: dict[str, list] = {}
    for name, columns in keys.items():
        unique = [(f"unique\t{name}.{','.join(columns)}", [F.col(c) for c in columns], F.lit(True))]
        filled = [(f"filled\t{name}.{c}", [F.lit("")], F.col(c).isNull()) for c in columns]
        wanted.setdefault(name, []).extend(unique + filled)
    for kind, side in (("reference", children), ("parent", parents)):
        for name, subjects in side.items():
            wanted.setdefault(name, []).extend((f"{kind}\t{edge}", *rest) for edge, *rest in subjects)
    counted = key_counts(tables, wanted)
    kind, subject = F.substring_index("subject", "\t", 1), F.substring_index("subject", "\t", -1)
    counted = counted.select(kind.alias("check"), subject.alias("subject"), F.col("key")[0].alias("first"), F.col("key"), "n")
    # A child key and its parent are rows of one subject and value: no join is needed to see whether both are there.
    linked = counted.where("check IN ('reference', 'parent')").groupBy("subject", "first").agg(
        F.sum(F.when(F.col("check") == "reference", F.col("n"))).alias("rows"), F.bool_or(F.col("check") == "parent").alias("known")
    )
    problems = linked.where("NOT known").groupBy(F.lit("reference").alias("check"), "subject").agg(F.sum("rows").alias("problems"))
    own = counted.where("check IN ('unique', 'filled')").groupBy("check", "subject").agg(
        F.sum(F.when(F.col("check") == "unique", F.col("n") - 1).otherwise(F.col("n"))).alias("problems")
    )
    every = [s for subjects in wanted.values() for s, *_ in subjects if not s.startswith("parent")]
    found = own.unionByName(problems).select(F.concat_ws("\t", "check", "subject").alias("subject"), "problems")
    return _with_all(found, every).select(
        kind.alias("check"), subject.alias("subject"), F.coalesce("problems", F.lit(0)).cast("bigint").alias("problems")
    )


def available_edges(tables: Mapping[str, DataFrame], edges: Sequence[Edge]) -> list[Edge]:
    """Edges whose two tables and columns are there."""
    return [
        e
        for e in edges
        if e.child in tables
        and e.parent in tables
        and e.child_key in tables[e.child].columns
        and e.parent_key in tables[e.parent].columns
    ]


def without_null(df: DataFrame, column: str) -> DataFrame:
    """Leave out the rows of a known anomaly: no value in ``column``."""
    return df.where(F.col(column).isNotNull())


def anomaly_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, rows with a null per column, and rows where all of the columns are null."""
    every = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.count_if(every).alias("null_all"),
    )


# --- import statistics ------------------------------------------------------------------------


def import_stats(products: DataFrame, nutrients: DataFrame) -> DataFrame:
    """One row: product and nutrient rows, and how many products lack a raw or normalised code."""
    share = lambda c: F.round(100 * F.count_if(c) / F.greatest(F.count("*"), F.lit(1)), 4)
    no_raw = F.coalesce(F.col("code_raw") == "", F.lit(True))
    no_norm = F.coalesce(F.col("code_norm") == "", F.lit(True))
    p = products.agg(
        F.count("*").alias("products"),
        F.count_if(no_raw).alias("missing_code_raw"),
        share(no_raw).alias("missing_code_raw_pct"),
        F.count_if(no_norm).alias("empty_code_norm"),
        share(no_norm).alias("empty_code_norm_pct"),
    )
    n = nutrients.agg(F.count("*").alias("nutrient_rows"))
    return _one_row([p, n])


def top_missing(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` columns that are null in most rows: ``(field, missing)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [x for c in columns for x in (F.lit(c), F.col(c))]
    return (
        counts.select(F.stack(F.lit(len(columns)), *cells).alias("field", "missing"))
        .orderBy(F.col("missing").desc(), "field")
        .limit(k)
    )


def run_totals(
    rows: DataFrame,
    products: DataFrame,
    nutrients: DataFrame,
    *,
    keep_first: bool = False,
    listed: DataFrame | None = None,
) -> DataFrame:
    """One row of load totals, counted from staged and written data.

    Counting what was written, not accumulators of the write, stays exact when tasks are re-run.
    ``rows(code_norm)`` is every record read, ``products(code_norm)`` what was kept; ``listed`` the
    codes that were resolved by score.
    """
    parts = [
        rows.agg(
            F.count("*").alias("rows_read"),
            F.count_if(F.col("code_norm") == "").alias("skipped_no_code"),
        ),
        products.agg(F.count("*").alias("products")),
        nutrients.agg(F.count("*").alias("nutrients")),
    ]
    if listed is not None:
        match = F.col("code_norm") == F.col("code")
        parts.append(
            products.join(listed, match, "left_semi").agg(F.count("*").alias("duplicates_resolved"))
        )
    zero = F.lit(0).cast("bigint")
    skipped = F.col("rows_read") - F.col("skipped_no_code") - F.col("products")
    return _one_row(parts).select(
        "products",
        "nutrients",
        "skipped_no_code",
        (skipped if keep_first else zero).alias("skipped_duplicate_code"),
        (zero if listed is None else F.col("duplicates_resolved")).alias("duplicates_resolved"),
    )


def throughput(inventory: DataFrame, elapsed_seconds: Column | float) -> DataFrame:
    """Rates of a run over the selected tables, and the extrapolated time of the whole bundle.

    ``inventory(table, bytes, expected_rows, selected)``.
    """
    seconds = elapsed_seconds if isinstance(elapsed_seconds, Column) else F.lit(elapsed_seconds)
    seconds = F.greatest(seconds, F.lit(1e-9))
    chosen = lambda c: F.coalesce(F.sum(F.when(F.col("selected"), F.col(c))), F.lit(0))
    totals = inventory.agg(
        chosen("bytes").cast("bigint").alias("selected_bytes"),
        chosen("expected_rows").cast("bigint").alias("selected_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bundle_bytes"),
        F.coalesce(F.sum("expected_rows"), F.lit(0)).cast("bigint").alias("bundle_rows"),
    )
    rows_per_s = F.when(F.col("selected_rows") > 0, F.col("selected_rows") / seconds)
    bytes_per_s = F.col("selected_bytes") / seconds
    return totals.select(
        "*",
        bytes_per_s.alias("bytes_per_s"),
        rows_per_s.alias("rows_per_s"),
        (F.col("bundle_bytes") / F.greatest(bytes_per_s, F.lit(1e-9))).alias("full_seconds_by_bytes"),
        F.when(F.col("bundle_rows") > 0, F.col("bundle_rows") / rows_per_s).alias("full_seconds_by_rows"),
    )


# --- dictionary coverage ----------------------------------------------------------------------

NO_BREAK_SPACE = "\u00a0"


#: Places of the text that one task looks at together.
_PLACES = 4096


def _texts(inventory: DataFrame, dictionary: str | DataFrame) -> DataFrame:
    if isinstance(dictionary, str):
        dictionary = inventory.sparkSession.createDataFrame([(dictionary,)], "text string")
    return dictionary.select(F.col("text").alias("_text"))


def mentioned(tokens: DataFrame, texts: DataFrame) -> DataFrame:
    """The distinct values of the one column of ``tokens`` that occur anywhere in a text (column ``_text``).

    The pieces of the texts that are as long as some token meet the tokens by equality.  Cost follows the texts
    times the different lengths of tokens, not their number.
    """
    name = tokens.columns[0]
    wanted = tokens.where(F.length(name) > 0).distinct()
    lengths = wanted.agg(F.collect_set(F.length(name)).alias("lengths")).scalar()
    starts = F.sequence(F.lit(1), F.greatest(F.length("_text"), F.lit(1)), F.lit(_PLACES))
    parts = texts.where("_text IS NOT NULL").select("_text", F.explode(lengths).alias("_length")).select(
        "_length", F.explode(F.transform(starts, lambda at: F.substring("_text", at, F.col("_length") + (_PLACES - 1)))).alias("_part")
    ).where("length(_part) >= _length")
    places = F.sequence(F.lit(1), F.length("_part") - F.col("_length") + 1)
    pieces = parts.repartition("_part").select(
        F.explode(F.array_distinct(F.transform(places, lambda at: F.substring("_part", at, F.col("_length"))))).alias("_piece")
    )
    return wanted.join(pieces, F.col(name) == F.col("_piece"), "left_semi")


def dictionary_coverage(
    inventory: DataFrame, dictionary: str | DataFrame, table: str = "table", header: str = "header"
) -> DataFrame:
    """Add ``table_found`` (whole word) and ``header_found`` (anywhere) to an inventory.

    The dictionary is a text, or a frame with texts in column ``text``.  Blank headers are left out.
    """
    texts = _texts(inventory, dictionary)
    rows = inventory.withColumn("_token", strip(F.col(header))).where(F.col("_token") != "")
    words = texts.select(F.explode(F.split("_text", r"(?U)\W+")).alias("_word")).distinct()
    found = mentioned(rows.select("_token"), texts.select(F.translate("_text", NO_BREAK_SPACE, " ").alias("_text")))
    return (
        rows.join(words, F.col(table) == F.col("_word"), "left")
        .join(found.select(F.col("_token").alias("_found")), F.col("_token") == F.col("_found"), "left")
        .withColumn("table_found", F.col("_word").isNotNull())
        .withColumn("header_found", F.col("_found").isNotNull())
        .drop("_token", "_word", "_found")
    )


def tables_not_mentioned(
    inventory: DataFrame, dictionary: str | DataFrame, table: str = "table"
) -> DataFrame:
    """Tables whose name the dictionary mentions nowhere, not even inside a word."""
    names = inventory.select(table).distinct()
    return names.join(mentioned(names, _texts(inventory, dictionary)), table, "left_anti")


def coverage_by_table(coverage: DataFrame, table: str = "table") -> DataFrame:
    """``(table, table_found, missing_headers)``."""
    return coverage.groupBy(table).agg(
        F.bool_or("table_found").alias("table_found"),
        F.count_if(~F.col("header_found")).alias("missing_headers"),
    )


# --- gates ------------------------------------------------------------------------------------


def identity_status(
    files: DataFrame, manifests: DataFrame, on: Sequence[str] = ("file_path",)
) -> DataFrame:
    """Compare fingerprints with manifests: adds ``status`` per file.

    Both sides hold ``file_sha256`` and ``file_bytes``.
    """
    m = manifests.select(
        *on,
        F.col("file_sha256").alias("_sha"),
        F.col("file_bytes").alias("_bytes"),
        F.lit(True).alias("_known"),
    )
    status = (
        F.when(F.col("_known").isNull(), "no manifest")
        .when(F.col("_sha").isNull() | (F.col("_sha") == ""), "manifest without file_sha256")
        .when(F.col("_sha") != F.col("file_sha256"), "sha-256 mismatch")
        .when(F.col("_bytes").isNull(), "manifest without file_bytes")
        .when(F.col("_bytes") != F.col("file_bytes"), "size mismatch")
        .otherwise("ok")
    )
    return files.join(m, list(on), "left").withColumn("status", status).drop("_sha", "_bytes", "_known")


def gate_identity(
    file: DataFrame, *, expected_sha256: str | None = None, manifest: Mapping | None = None
) -> None:
    """Refuse a file (one row of ``file_sha256``, ``file_bytes``) that is not the one that was profiled.

    What the caller expects and what the manifest records are both claims about the file; the first
    one whose ``identity_status`` is not ``ok`` refuses it.
    """
    claims = []
    if expected_sha256:
        claims.append(file.select(F.lit("1 expected").alias("claim"), F.lit(expected_sha256).alias("file_sha256"), "file_bytes"))
    if manifest is not None:
        recorded = [F.lit(manifest[c]).cast(t).alias(c) for c, t in (("file_sha256", "string"), ("file_bytes", "bigint"))]
        claims.append(file.select(F.lit("2 manifest").alias("claim"), *recorded))
    if not claims:
        raise GateError("give the expected SHA-256 or a preflight manifest")
    made = _union(claims)
    files = made.select("claim").join(file.select("file_sha256", "file_bytes"))
    refused = identity_status(files, made, ["claim"]).where("status <> 'ok'").orderBy("claim").first()
    if refused:
        raise GateError(
            f"{refused['claim'][2:]}: {refused['status']} (the file has SHA-256 {refused['file_sha256']}, "
            f"{refused['file_bytes']} bytes)"
        )


def holds_duplicates(manifest: Mapping | None) -> bool:
    """Whether a manifest says that its file holds repeated codes."""
    if manifest is None:
        return False
    if manifest["duplicates_found"] is None:
        raise GateError("manifest without duplicates_found")
    return any(manifest[f] for f in ("duplicates_found", "duplicate_values", "duplicate_occurrences"))


def gate_duplicates(has_duplicates: bool, *, keep_first: bool, has_codes: bool) -> None:
    """Refuse a file with known duplicates when nothing says how to resolve them."""
    if has_duplicates and not keep_first and not has_codes:
        raise GateError("the file holds duplicate codes: give the code list or keep the first row")


def gate_load_options(*, resume: bool, drop: bool, truncate: bool) -> None:
    if resume and (drop or truncate):
        raise GateError("resume excludes drop and truncate")


def gate_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Refuse rows that share a key."""
    found = repeated_keys(df, keys).limit(1).collect()
    if found:
        raise GateError(f"{table}: key {', '.join(keys)} occurs {found[0]['n']} times: "
                        f"{[found[0][k] for k in keys]}")


def gate_not_null(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Refuse rows without a key."""
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if not df.where(empty).isEmpty():
        raise GateError(f"{table}: a row has no {', '.join(keys)}")
