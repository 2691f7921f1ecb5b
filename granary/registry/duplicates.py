"""Duplicate profiles, resolution and whole product loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary import catalog
from granary.operators.dedupe import (
    completeness_score,
    duplicate_keys,
    duplicate_sample,
    keep_best,
    keep_first,
    profile_duplicates,
    resolve_listed,
    row_cap,
    split_by_list,
    with_key,
)
from granary.operators.quality import run_totals
from granary.operators.reshape import fields_for, nutrient_table, product_rows, product_table
from granary.plans.products import load_products, resolve_rows
from granary.registry.base import (
    EXPORT,
    EXPORT_BLOCK,
    EXPORT_ORDER,
    EXPORT_SQL,
    as_text,
    derive,
    product_export,
    query,
    select_sql,
    table,
)
from granary.registry.reshape import sql_long_rows, sql_products, sql_value
from granary.session import stage

# codes with a hot value, empty values and one-off values
_LINE_CODES = {
    "code": "CASE WHEN l_returnflag = 'A' THEN '0' WHEN l_partkey % 10 = 0 THEN '' "
            f"ELSE {as_text('l_partkey * 1000 + l_suppkey')} END",
}
_LINE_COUNTS = f"SELECT code, count(*) AS n FROM ({select_sql(_LINE_CODES, 'lineitem')}) l GROUP BY code"
_PROFILE = """
    SELECT CAST(coalesce(sum(n) FILTER (code <> ''), 0) AS BIGINT) AS code_total,
           count(*) FILTER (code <> '') AS code_unique,
           count(*) FILTER (code <> '' AND n > 1) AS duplicate_values,
           CAST(coalesce(sum(n - 1) FILTER (code <> ''), 0) AS BIGINT) AS duplicate_occurrences,
           CAST(coalesce(sum(n) FILTER (code = ''), 0) AS BIGINT) AS skipped_no_code,
           count(*) FILTER (code <> '' AND n > 1) > 0 AS duplicates_found
    FROM ({counts}) c
"""


def _line_codes(spark, sf_dir):
    return derive(table(spark, sf_dir, "lineitem"), _LINE_CODES)


@query("dup_profile", _PROFILE.format(counts=_LINE_COUNTS))
def _dup_profile(spark, sf_dir):
    return profile_duplicates(_line_codes(spark, sf_dir), "code")


_EXPORT_CODES = f"SELECT {sql_products().split(' AS code_norm')[0]} AS code FROM ({EXPORT_SQL}) e"


@query("dup_profile_export", _PROFILE.format(
    counts=f"SELECT code, count(*) AS n FROM ({_EXPORT_CODES}) x GROUP BY code"))
def _dup_profile_export(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir))
    return profile_duplicates(rows, "code_norm")


@query("dup_codes", f"SELECT code FROM ({_LINE_COUNTS}) c WHERE code <> '' AND n > 1")
def _dup_codes(spark, sf_dir):
    return duplicate_keys(_line_codes(spark, sf_dir), "code").orderBy("code")


@query("dup_sample", f"SELECT code FROM ({_LINE_COUNTS}) c WHERE code <> '' AND n > 1 ORDER BY code LIMIT 20")
def _dup_sample(spark, sf_dir):
    return duplicate_sample(_line_codes(spark, sf_dir), "code")


@query("dedupe_first", """
    SELECT event_id, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) e
    WHERE rn = 1
""")
def _dedupe_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    return keep_first(events, "user_id", ["event_id"])


_SCORED = """
    SELECT event_id, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
            (epoch_us(ts) // 60000000) % 100 DESC, CASE WHEN value > 20 THEN 1 ELSE 0 END
            + CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END DESC, event_id) AS rn FROM events) e
    WHERE rn = 1
"""


@query("dedupe_best", _SCORED)
def _dedupe_best(spark, sf_dir):
    minute = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)") % 100
    filled = (F.col("value") > 20).cast("int") + (F.col("event_type") != "error").cast("int")
    events = table(spark, sf_dir, "events")
    best = keep_best(events, "user_id", [minute, filled], ["event_id"])
    return best.select("event_id", "user_id", "event_type", "value", "props")


def sql_score(mode: str = "minimal") -> str:
    """Score columns over the export: time, emitted rows, filled fields."""
    emitted = " + ".join(
        f"CASE WHEN {sql_value(f.source_field, mode)} IS NOT NULL THEN 1 ELSE 0 END"
        for f in fields_for(mode, list(EXPORT))
    )
    filled = " + ".join(
        f"CASE WHEN {c} <> '' THEN 1 ELSE 0 END" for c in catalog.PRODUCT_TEXT_FIELDS
    ) + " + CASE WHEN last_modified_t IS NOT NULL THEN 1 ELSE 0 END"
    return emitted, filled


def sql_typed(mode: str = "minimal") -> str:
    """The export with product columns, score parts and its raw nutrient text."""
    emitted, filled = sql_score(mode)
    raw = ", ".join(f'"{c}"' for c in EXPORT if c.endswith("_100g") and c not in catalog.PRODUCT_SCHEMA.names)
    clash = ", ".join(f'"{c}" AS "raw {c}"' for c in EXPORT if c in catalog.WIDE_NUTRIENT_COLUMNS)
    return (
        f"SELECT *, {filled} AS filled, coalesce(last_modified_t, -1) AS modified FROM "
        f"(SELECT event_id, {sql_products()}, CAST({emitted} AS BIGINT) AS emitted, {raw}, {clash} "
        f"FROM ({EXPORT_SQL}) e0) e1"
    )


_TYPED = sql_typed()
_BEST = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code_norm ORDER BY
        modified DESC, emitted DESC, filled DESC, event_id) AS rn FROM ({_TYPED}) t
        WHERE code_norm <> '') r WHERE rn = 1
"""
_COLUMNS = ", ".join(catalog.PRODUCT_SCHEMA.names)


@query("completeness_score", f"SELECT event_id, modified, emitted, CAST(filled AS BIGINT) AS filled FROM ({_TYPED}) t")
def _completeness_score(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir), keep=["event_id"])
    modified, emitted, filled = completeness_score(F.col("emitted"))
    return rows.select(
        "event_id", modified.alias("modified"), emitted.cast("bigint").alias("emitted"),
        filled.cast("bigint").alias("filled"),
    )


def _typed_export(spark, sf_dir):
    """Typed rows of the export, staged as a load does when several steps use them."""
    rows, _, _ = product_rows(product_export(spark, sf_dir), keep=EXPORT_ORDER)
    return stage(rows.withColumn("piece", F.expr(EXPORT_BLOCK)), "export")


def _resolved(spark, sf_dir, dedupe="best"):
    rows, fields, names = product_rows(product_export(spark, sf_dir), keep=EXPORT_ORDER)
    return resolve_rows(rows, EXPORT_ORDER, dedupe), fields, names


@query("product_load", f"SELECT {_COLUMNS} FROM ({_BEST}) b")
def product_load(spark, sf_dir):
    return product_table(_resolved(spark, sf_dir)[0])


@query("product_load_first", f"""
    SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY code_norm ORDER BY event_id) AS rn
    FROM ({_TYPED}) t WHERE code_norm <> '') r WHERE rn = 1
""")
def _product_load_first(spark, sf_dir):
    return product_table(_resolved(spark, sf_dir, "memory")[0])


_WINNERS_RAW = f"SELECT b.code_norm, x.* FROM ({_BEST}) b JOIN ({EXPORT_SQL}) x ON x.event_id = b.event_id"


@query("nutrient_load", f"WITH w AS ({_WINNERS_RAW}) {sql_long_rows('w', 'code_norm')}")
def nutrient_load(spark, sf_dir):
    winners, fields, names = _resolved(spark, sf_dir)
    return nutrient_table(winners, fields, names)


_LISTED = f"""
    SELECT code_norm FROM ({_TYPED}) t WHERE code_norm <> '' GROUP BY code_norm HAVING count(*) > 1
    AND CAST(code_norm AS BIGINT) % 2 = 0
"""


def _listed(rows):
    """A code list that covers only some of the repeated codes."""
    return duplicate_keys(rows, "code_norm").where(F.col("code").cast("bigint") % 2 == 0)


@query("dedupe_listed", f"""
    SELECT event_id, code_norm, resolved FROM (
        SELECT event_id, code_norm, code_norm IN (SELECT code_norm FROM ({_LISTED}) c) AS resolved,
               row_number() OVER (PARTITION BY code_norm ORDER BY modified DESC, emitted DESC, filled DESC, event_id) AS rn
        FROM ({_TYPED}) t WHERE code_norm <> '') r
    WHERE rn = 1 OR NOT resolved
""")
def _dedupe_listed(spark, sf_dir):
    rows = _typed_export(spark, sf_dir)
    score = completeness_score(F.col("emitted"))
    kept = resolve_listed(with_key(rows), _listed(rows), "code_norm", score, EXPORT_ORDER)
    return kept.select("event_id", "code_norm", "resolved")


@query("list_membership", f"""
    SELECT CASE WHEN code_norm IN (SELECT code_norm FROM ({_LISTED}) c) THEN 'deferred' ELSE 'passed' END AS kind,
           count(*) AS rows FROM ({_TYPED}) t WHERE code_norm <> '' GROUP BY 1
""")
def _list_membership(spark, sf_dir):
    rows = _typed_export(spark, sf_dir)
    passed, deferred = split_by_list(with_key(rows), _listed(rows), "code_norm")
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind")).agg(F.count("*").alias("rows"))
    return count(passed, "passed").unionByName(count(deferred, "deferred"))


# the cap is a share of the table, so the cut-off row moves with the data
_CAP = f"""
    WITH t AS ({_TYPED}), listed AS ({_LISTED}),
    keyed AS (SELECT *, code_norm IN (SELECT code_norm FROM listed) AS deferred FROM t WHERE code_norm <> ''),
    cap AS (SELECT min(event_id) AS last FROM (
        SELECT event_id, row_number() OVER (ORDER BY event_id) AS n,
               (SELECT count(*) // 10 FROM events) AS wanted FROM keyed WHERE NOT deferred) p WHERE n = wanted)
    SELECT event_id, code_norm FROM (
        SELECT event_id, code_norm, deferred, row_number() OVER (PARTITION BY code_norm
            ORDER BY modified DESC, emitted DESC, filled DESC, event_id) AS rn
        FROM keyed WHERE event_id <= coalesce((SELECT last FROM cap), event_id)) r
    WHERE rn = 1 OR NOT deferred
"""


@query("row_cap", _CAP)
def _row_cap(spark, sf_dir):
    rows = _typed_export(spark, sf_dir)
    wanted = table(spark, sf_dir, "events").count() // 10
    codes = stage(_listed(rows), "listed")
    kept = resolve_rows(rows, EXPORT_ORDER, "none", codes, wanted, ("piece",))
    return kept.select("event_id", "code_norm")


@query("row_cap_plain", """
    SELECT event_id, user_id FROM events WHERE event_id <= (SELECT max(event_id) FROM (
        SELECT event_id, row_number() OVER (ORDER BY event_id) AS n,
               (SELECT count(*) // 5 FROM events) AS wanted FROM events WHERE event_type <> 'error') p
        WHERE n <= wanted)
""")
def _row_cap_plain(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    counted = events.where("event_type <> 'error'")
    kept = row_cap(events, counted, ["event_id"], events.count() // 5, [F.expr(EXPORT_BLOCK)])
    return kept.select("event_id", "user_id")


@query("run_totals", f"""
    SELECT (SELECT count(*) FROM ({_BEST}) b) AS products,
           (SELECT CAST(sum(emitted) AS BIGINT) FROM ({_BEST}) b) AS nutrients,
           (SELECT count(*) FROM ({_TYPED}) t WHERE code_norm = '') AS skipped_no_code,
           CAST(0 AS BIGINT) AS skipped_duplicate_code,
           (SELECT count(*) FROM (SELECT code_norm FROM ({_TYPED}) t WHERE code_norm <> '' GROUP BY code_norm
                                  HAVING count(*) > 1) d) AS duplicates_resolved
""")
def _run_totals(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir))
    winners, fields, names = _resolved(spark, sf_dir)
    return run_totals(
        rows, winners, nutrient_table(winners, fields, names), listed=duplicate_keys(rows, "code_norm")
    )


@query("run_totals_first", f"""
    SELECT (SELECT count(*) FROM ({_BEST}) b) AS products,
           (SELECT CAST(sum(emitted) AS BIGINT) FROM (
               SELECT emitted, row_number() OVER (PARTITION BY code_norm ORDER BY event_id) AS rn
               FROM ({_TYPED}) t WHERE code_norm <> '') f WHERE rn = 1) AS nutrients,
           (SELECT count(*) FROM ({_TYPED}) t WHERE code_norm = '') AS skipped_no_code,
           (SELECT count(*) FROM ({_TYPED}) t WHERE code_norm <> '') - (SELECT count(*) FROM ({_BEST}) b)
               AS skipped_duplicate_code,
           CAST(0 AS BIGINT) AS duplicates_resolved
""")
def _run_totals_first(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir))
    first, fields, names = _resolved(spark, sf_dir, "memory")
    return run_totals(rows, first, nutrient_table(first, fields, names), keep_first=True)


_READ_CAPPED = f"""
    SELECT * FROM ({_TYPED}) t WHERE event_id <= coalesce((
        SELECT min(event_id) FROM (
            SELECT event_id, row_number() OVER (ORDER BY event_id) AS n FROM (
                SELECT event_id, row_number() OVER (PARTITION BY code_norm ORDER BY event_id) AS rn
                FROM ({_TYPED}) t WHERE code_norm <> '') f WHERE rn = 1) p
        WHERE n = (SELECT count(*) // 100 FROM events)), event_id)
"""


@query("run_totals_capped", f"""
    SELECT count(DISTINCT code_norm) FILTER (code_norm <> '') AS products,
           (SELECT CAST(sum(emitted) AS BIGINT) FROM (
               SELECT emitted, row_number() OVER (PARTITION BY code_norm ORDER BY event_id) AS rn
               FROM ({_READ_CAPPED}) r WHERE code_norm <> '') f WHERE rn = 1) AS nutrients,
           count(*) FILTER (code_norm = '') AS skipped_no_code,
           count(*) FILTER (code_norm <> '') - count(DISTINCT code_norm) FILTER (code_norm <> '')
               AS skipped_duplicate_code,
           CAST(0 AS BIGINT) AS duplicates_resolved
    FROM ({_READ_CAPPED}) c
""")
def _run_totals_capped(spark, sf_dir):
    """A cap that the load itself applies: what is behind it counts nowhere."""
    cap = table(spark, sf_dir, "events").count() // 100
    load = load_products(
        spark, product_export(spark, sf_dir), dedupe="memory", max_rows=cap, order=EXPORT_ORDER, block=EXPORT_ORDER
    )
    return run_totals(load.rows, load.products, load.nutrients, keep_first=True)


@query("run_totals_best", f"""
    SELECT (SELECT count(*) FROM ({_BEST}) b) AS products,
           (SELECT CAST(sum(emitted) AS BIGINT) FROM ({_BEST}) b) AS nutrients,
           (SELECT count(*) FROM ({_TYPED}) t WHERE code_norm = '') AS skipped_no_code,
           CAST(0 AS BIGINT) AS skipped_duplicate_code,
           (SELECT count(*) FROM (SELECT code_norm FROM ({_TYPED}) t WHERE code_norm <> '' GROUP BY code_norm
                                  HAVING count(*) > 1) d) AS duplicates_resolved
""")
def _run_totals_best(spark, sf_dir):
    """Every repeated code is resolved, without a list."""
    load = load_products(spark, product_export(spark, sf_dir), dedupe="best", order=EXPORT_ORDER)
    return run_totals(load.rows, load.products, load.nutrients, listed=duplicate_keys(load.rows, "code_norm"))
