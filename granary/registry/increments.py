"""Incremental loads over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators.dedupe import completeness_score
from granary.operators.reshape import nutrient_table, product_rows, product_table
from granary.registry.base import EXPORT_SQL, product_export, query, table
from granary.registry.duplicates import _BEST, _COLUMNS
from granary.registry.reshape import sql_long_rows
from granary.session import scratch_path, stage
from granary.sources.delimited import read_delimited, record_numbers
from granary.streaming.buckets import read_buckets, upsert_buckets
from granary.streaming.incremental import (
    compact,
    current_rows,
    ingest_increment,
    read_stream,
    read_target,
    upsert_increment,
)


def _halves(df, order: str):
    """Earlier and later rows, cut at the middle of the order column's range."""
    middle = df.agg((F.min(order) + F.max(order)) / 2).first()[0]
    return df.where(F.col(order) <= middle), df.where(F.col(order) > middle)


@query("incremental_load", """
    SELECT event_id, user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) e WHERE rn = 1
""")
def _incremental_load(spark, sf_dir):
    """New users only, from two deliveries of files."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    inbox, target, checkpoint = (scratch_path(spark, n) for n in ("inbox", "loaded", "offsets"))
    for part in _halves(events, "event_id"):
        part.write.mode("append").parquet(inbox)
        ingest_increment(read_stream(spark, inbox, events.schema), target, "user_id", checkpoint, ["event_id"])
    return read_target(spark, target, events.schema).select(*events.columns)


@query("resume_load", "SELECT event_id, user_id, event_type, props FROM events")
def _resume_load(spark, sf_dir):
    """A load that stopped after a third of the records goes on behind them."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    source, target = scratch_path(spark, "resume-source"), scratch_path(spark, "resumed")
    events.write.option("header", True).option("sep", "\t").option("escape", '"').csv(source)
    scan = record_numbers(stage(read_delimited(spark, source, with_order=True), "resume-scan"))
    rows = scan.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"),
        "event_type", "props", "record_number",
    )
    rows.where(F.col("record_number") <= scan.count() / 3).write.parquet(target)
    loaded = spark.read.parquet(target).count()
    rows.where(F.col("record_number") > loaded + 1).write.mode("append").parquet(target)
    return spark.read.schema(events.schema).parquet(target)


def _typed(spark, sf_dir):
    rows, fields, names = product_rows(product_export(spark, sf_dir), keep=["event_id"])
    return stage(rows.where("code_norm <> ''"), "typed-versions"), fields, names


def _versions(spark, sf_dir):
    """Product versions loaded in two deliveries; returns what reads them back."""
    rows, fields, names = _typed(spark, sf_dir)
    inbox, target, checkpoint = (scratch_path(spark, n) for n in ("inbox", "versions", "offsets"))
    score = completeness_score(F.col("emitted"))
    for part in _halves(rows, "event_id"):
        part.write.mode("append").parquet(inbox)
        upsert_increment(
            read_stream(spark, inbox, rows.schema), target, "code_norm", checkpoint, score, ["event_id"])
    return target, rows.schema, score, fields, names


@query("upsert", f"SELECT {_COLUMNS} FROM ({_BEST}) b")
def _upsert(spark, sf_dir):
    target, schema, score, _, _ = _versions(spark, sf_dir)
    return product_table(current_rows(spark, target, schema, "code_norm", score, ["event_id"]))


@query("upsert_nutrients", f"""
    WITH w AS (SELECT b.code_norm, x.* FROM ({_BEST}) b JOIN ({EXPORT_SQL}) x ON x.event_id = b.event_id)
    {sql_long_rows('w', 'code_norm')}
""")
def _upsert_nutrients(spark, sf_dir):
    """Long rows rebuilt from the current versions, after the versions were compacted."""
    target, schema, score, fields, names = _versions(spark, sf_dir)
    smaller = scratch_path(spark, "compacted")
    compact(spark, target, smaller, schema, "code_norm", score, ["event_id"])
    current = current_rows(spark, smaller, schema, "code_norm", score, ["event_id"])
    return nutrient_table(current, fields, names)


@query("upsert_buckets", f"SELECT {_COLUMNS} FROM ({_BEST}) b")
def _upsert_buckets(spark, sf_dir):
    """Two deliveries merged into a target by key bucket; the read ranks nothing."""
    rows, _, _ = _typed(spark, sf_dir)
    inbox, target, checkpoint = (scratch_path(spark, n) for n in ("inbox", "buckets", "offsets"))
    score = completeness_score(F.col("emitted"))
    for part in _halves(rows, "event_id"):
        part.write.mode("append").parquet(inbox)
        upsert_buckets(
            read_stream(spark, inbox, rows.schema), target, "code_norm", checkpoint, score, ["event_id"], buckets=16)
    return product_table(read_buckets(spark, target, rows.schema))
