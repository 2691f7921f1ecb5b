"""The target by key bucket: what a batch touches, replays, crashes."""

import pytest
from granary.streaming import buckets
from granary.streaming.buckets import best_rows, merge_batch, read_buckets, read_head
from pyspark.sql import functions as F

SCHEMA = "code string, i long, v long"


def MERGE(batch, current):
    return best_rows("code", [F.col("v")], ["i"])(batch, current)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def current(spark, target, schema):
    return sorted(tuple(r) for r in read_buckets(spark, target, schema).collect())


def test_batches_rewrite_only_what_they_touch(spark, tmp_path):
    target = str(tmp_path / "t")
    first = frame(spark, [(f"k{i}", i, i % 3) for i in range(100)] + [("k1", 200, 9), ("k2", 201, 2)])
    merge_batch(first, target, "1", "code", MERGE, 32)
    want = {f"k{i}": (i, i % 3) for i in range(100)} | {"k1": (200, 9)}
    assert current(spark, target, first.schema) == sorted((k, *x) for k, x in want.items())
    before = read_head(spark, target)
    touched = merge_batch(frame(spark, [("k7", 300, 8), ("k8", 301, 1), ("new", 302, 0)]), target, "2", "code", MERGE, 32)
    assert 1 <= len(touched) <= 3
    want |= {"k7": (300, 8), "new": (302, 0)}
    assert current(spark, target, first.schema) == sorted((k, *x) for k, x in want.items())
    after = read_head(spark, target)
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    opened = read_buckets(spark, target, first.schema, before, touched).inputFiles()
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in opened} == set(touched)
    plan = read_buckets(spark, target, first.schema)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_replay_and_crash(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    one, two = frame(spark, [("a", 1, 1), (None, 2, 5)]), frame(spark, [("a", 3, 1), ("b", 4, 4), (None, 5, 6)])
    merge_batch(one, target, "1", "code", MERGE, 4)
    shown = read_buckets(spark, target, one.schema)
    rows = sorted(map(tuple, shown.collect()), key=str)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # the data is written, the head is not
        patch.setattr(spark, "createDataFrame", killed)
        with pytest.raises(KeyboardInterrupt):
            buckets._write(target, two.withColumn("bucket", buckets.bucket_of("code", 4)), [0, 1, 2, 3], {}, "2")
    assert sorted(map(tuple, read_buckets(spark, target, one.schema).collect()), key=str) == rows
    for _ in range(2):  # the batch, and its replay
        merge_batch(two, target, "2", "code", MERGE, 4)
        got = sorted(map(tuple, read_buckets(spark, target, one.schema).collect()), key=str)
        assert got == sorted([("a", 1, 1), ("b", 4, 4), (None, 5, 6)], key=str)
    merge_batch(one.limit(0), target, "3", "code", MERGE, 4)
    assert read_buckets(spark, target, one.schema).count() == 3
