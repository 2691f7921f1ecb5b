"""Incremental loads by key filters against sets, and what they open."""

import random

import pytest
from pyspark.sql import functions as F

from granary.streaming import ingest_increment, read_stream
from granary.streaming.incremental import _folder, new_keys, read_target, written_folders
from granary.streaming.keyfilters import filters_of, prepare_filters, suspects, write_filter

SCHEMA = "k long, t string, x double"


def _target(spark, path, parts, keys, bare=()):
    """A target of some folders, each of the rows of one part; ``bare`` ones have no filter."""
    schema = spark.createDataFrame([], SCHEMA).schema
    prepare_filters(spark, path, schema, keys, ("0", -1))
    for number, rows in enumerate(parts):
        folder = ("r", number)
        spark.createDataFrame(rows, SCHEMA).write.parquet(_folder(path, folder))
        if number not in bare:
            write_filter(spark.read.schema(schema).parquet(_folder(path, folder)), path, keys, folder)
    return schema


@pytest.mark.parametrize("keys", [["k"], ["t"], ["k", "t"], ["x"]])
def test_new_keys_match_sets(spark, tmp_path, keys):
    picks = random.Random(7)
    row = lambda: (picks.choice([None, *range(60)]), picks.choice([None, "", "é", "b", "B"]), picks.choice([0.0, -0.0, float("nan"), None, 1.5]))
    parts = [[row() for _ in range(n)] for n in (40, 0, 1, 25)]
    path = str(tmp_path / "t")
    schema = _target(spark, path, parts, keys, bare={2})
    folders = written_folders(spark, path, schema)
    assert folders == [("r", n) for n in (0, 1, 2, 3)]
    batch = spark.createDataFrame([row() for _ in range(80)], SCHEMA)
    for older in (folders, [f for f in folders if f[1] != 2]):
        want = batch
        for f in older:
            want = want.join(spark.read.schema(schema).parquet(_folder(path, f)).select(*keys), keys, "left_anti").select("k", "t", "x")
        got = new_keys(batch, path, keys, older).select("k", "t", "x")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_new_keys_open_no_old_file(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = _target(spark, path, [[(2 * i, "a", 0.0) for i in range(a, a + 500)] for a in (0, 500, 1000)], ["k"])
    folders = written_folders(spark, path, schema)
    frame = lambda keys: spark.createDataFrame([(k, "b", 1.0) for k in keys], SCHEMA)
    later = new_keys(frame(range(10_000, 10_400)), path, ["k"], folders)  # beyond all bounds
    assert later.count() == 400 and not later.inputFiles()
    between = new_keys(frame([2 * 100 + 1]), path, ["k"], folders)  # inside bounds, in no filter
    assert between.count() == 1 and not between.inputFiles()
    one = new_keys(frame([1200, 1201]), path, ["k"], folders)  # one folder holds the first
    assert [r["k"] for r in one.collect()] == [1201]
    assert {f.rsplit("/", 2)[1] for f in one.inputFiles()} == {"batch_id=1"}
    passed = suspects(frame(range(1, 3001, 2)), path, ["k"], folders)[0].distinct().count()
    assert passed < 30  # under 2 % of keys that are not there pass


def test_filters_of_loads(spark, tmp_path):
    """Every batch of a load leaves a filter; one without a key, or with null keys alone, lets nothing pass."""
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    for number, rows in enumerate([[(1, "a", 0.0), (1, "b", 0.0), (None, "c", 0.0)], [(1, "d", 0.0)], [(2, "e", 0.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        ingest_increment(read_stream(spark, inbox, schema), target, "k", str(tmp_path / "cp"), ["t"])
        assert filters_of(spark, target, schema, ["k"]).count() == number + 1
    rows = [(r["k"], r["t"]) for r in read_target(spark, target, schema).collect()]
    assert sorted(rows, key=str) == [(1, "a"), (2, "e"), (None, "c")]
    assert read_target(spark, target, schema).where(F.col("batch_id") == 1).isEmpty()
    ingest_increment(read_stream(spark, inbox, schema), target, ["t", "k"], str(tmp_path / "cp2"), ["t"])
    assert filters_of(spark, target, schema, ["t", "k"]).count() == 1  # other keys have filters of their own
