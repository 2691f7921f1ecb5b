"""Run events: ``(ts, event, fields)`` rows appended as JSON lines or as text lines.

Fields are pairs of text in the order in which they were given.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("jsonl", "text")
EVENT_SCHEMA = "event string, fields array<struct<key:string,value:string>>"
STAMP = "%Y-%m-%dT%H:%M:%S+00:00"


def event_rows(df: DataFrame, event: Column | str, fields: Mapping[str, Column]) -> DataFrame:
    """One event per row of ``df``; null fields are left out."""
    pairs = [F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in fields.items()]
    given = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())
    name = F.lit(event) if isinstance(event, str) else event
    return df.select(name.alias("event"), given.alias("fields"))


def field(name: str) -> Column:
    """The value of one field of an event row, null where it has none."""
    return F.get(F.filter("fields", lambda p: p["key"] == name), F.lit(0))["value"]


def log_events(events: DataFrame, path: str, fmt: str = "jsonl") -> None:
    """Append events to a folder; those without ``ts`` get the time of the write, in UTC seconds."""
    if fmt not in FORMATS:
        raise ValueError(f"log format must be one of {', '.join(FORMATS)}")
    if "ts" not in events.columns:
        utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
        stamp = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
        events = events.withColumn("ts", stamp)
    if fmt == "jsonl":
        events.select("ts", "event", "fields").write.mode("append").json(path)
        return
    pairs = F.transform("fields", lambda e: F.concat_ws("=", e["key"], e["value"]))
    line = F.concat_ws(" ", F.format_string("[%s]", F.col("ts")), F.col("event"), F.array_join(pairs, " "))
    events.select(F.rtrim(line).alias("value")).write.mode("append").text(path)


class RunLog:
    """The events of one job: each is stamped and appended when it happens, so a run that is killed
    leaves what it had logged.  Threads of the job take turns.  Without a path nothing is written."""

    def __init__(self, spark: SparkSession, path: str | None, fmt: str = "jsonl"):
        if fmt not in FORMATS:
            raise ValueError(f"log format must be one of {', '.join(FORMATS)}")
        self.spark, self.path, self.fmt = spark, path, fmt
        self.turn = threading.Lock()

    def event(self, name: str, **fields: object) -> None:
        if not self.path:
            return
        pairs = [(k, str(v)) for k, v in fields.items() if v is not None]
        with self.turn:
            row = [(time.strftime(STAMP, time.gmtime()), name, pairs)]
            log_events(self.spark.createDataFrame(row, f"ts string, {EVENT_SCHEMA}").coalesce(1), self.path, self.fmt)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events logged as JSON lines."""
    return spark.read.schema(f"ts string, {EVENT_SCHEMA}").json(path)
