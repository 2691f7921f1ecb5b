import random

import pytest
from pyspark.sql import functions as F

from granary.operators.dedupe import (
    completeness_score,
    keep_best,
    keep_first,
    profile_duplicates,
    row_cap,
)
from granary.sinks.layout import write_clustered, write_layout
from granary.operators.enrich import label
from granary.operators.quality import GateError, gate_unique
from granary.sinks.tables import (
    create_database,
    create_table,
    read_table,
    snapshot_schema,
    write_bucketed,
    write_table,
)
from granary.sources.delimited import SOURCE_ORDER, read_delimited, record_numbers
from granary.sources.fingerprint import fingerprint
from granary.session import stage
from granary.streaming import compact, current_rows, ingest_increment, read_stream, upsert_increment
from granary.streaming.incremental import read_target


def _rows(n, seed):
    picks = random.Random(seed)
    return [
        (i, "hot" if picks.random() < 0.3 else f"k{picks.randrange(40)}" if picks.random() < 0.95 else "",
         picks.choice([None, -5, 1, 2, 3]), picks.randrange(3), picks.choice(["", "x"]))
        for i in range(n)
    ]


SCHEMA = "i long, code string, last_modified_t long, emitted int, name string"


def test_resolution_matches_a_loop_over_many_splits(spark):
    rows = _rows(3000, 3)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(17).where("code <> ''")
    first, best = {}, {}
    for i, code, modified, emitted, name in rows:
        if code:
            first.setdefault(code, i)
            score = (-1 if modified is None else modified, emitted, (name != "") + (modified is not None))
            if code not in best or score > best[code][0]:
                best[code] = (score, i)
    score = completeness_score(F.col("emitted"), ["name", "last_modified_t"])
    assert {r["code"]: r["i"] for r in keep_first(frame, "code", ["i"]).collect()} == first
    assert {r["code"]: r["i"] for r in keep_best(frame, "code", score, ["i"]).collect()} == {
        c: i for c, (_, i) in best.items()}
    plan = keep_best(frame, "code", score, ["i"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before the shuffle, one after it
    profile = profile_duplicates(spark.createDataFrame(rows, SCHEMA), "code").first()
    filled = [r[1] for r in rows if r[1]]
    assert (profile["code_total"], profile["code_unique"]) == (len(filled), len(set(filled)))
    assert profile["skipped_no_code"] == len(rows) - len(filled)


@pytest.mark.parametrize("n", [1, 7, 120, 5000])
def test_row_cap_matches_a_loop(spark, n):
    rows = _rows(400, n)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    counted, want = 0, []
    for i, code, *_ in rows:
        if counted >= n:
            break
        want.append(i)
        counted += code != "hot"
    got = row_cap(frame, frame.where("code <> 'hot'"), ["i"], n, [F.expr("i div 16")])
    assert sorted(r["i"] for r in got.collect()) == want


def test_source_order_over_files_and_splits(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(4000)]
    for part, name in enumerate("abc"):
        body = "\n".join(["id,t", *lines[part * 1000:(part + 1) * 1000]]) + "\n"
        (tmp_path / f"{name}.csv").write_text(body)
    import gzip
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("\n".join(["id,t", *lines[3000:]]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = stage(read_delimited(spark, str(tmp_path), with_order=True), "ordered")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert scan.select("_src_block").distinct().count() > 3
    numbered = record_numbers(scan).select(F.col("id").cast("int").alias("id"), "record_number").collect()
    assert sorted(r["id"] for r in numbered) == list(range(4000))
    assert all(r["record_number"] == r["id"] + 2 for r in numbered)
    first = keep_first(scan.withColumn("k", F.col("id").cast("int") % 3), "k", SOURCE_ORDER)
    assert {r["id"] for r in first.collect()} == {"0", "1", "2"}


def test_increments_survive_replay_and_new_checkpoints(spark, tmp_path):
    rows = _rows(300, 9)
    schema = spark.createDataFrame([], SCHEMA).schema
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    versions, smaller = str(tmp_path / "versions"), str(tmp_path / "small")
    score = completeness_score(F.col("emitted"), ["name", "last_modified_t"])
    spark.createDataFrame(rows[:150], schema).write.mode("append").parquet(inbox)
    ingest_increment(read_stream(spark, inbox, schema), target, "code", str(tmp_path / "cp"), ["i"])
    once = read_target(spark, target, schema).count()
    ingest_increment(read_stream(spark, inbox, schema), target, "code", str(tmp_path / "cp"), ["i"])
    assert read_target(spark, target, schema).count() == once  # nothing new, nothing twice
    upsert_increment(read_stream(spark, inbox, schema), versions, "code", str(tmp_path / "cpv"), score, ["i"])
    spark.createDataFrame(rows[150:], schema).write.mode("append").parquet(inbox)
    # a new checkpoint reads the whole inbox again and still adds new keys only
    ingest_increment(read_stream(spark, inbox, schema), target, "code", str(tmp_path / "cp2"), ["i"])
    loaded = [r["code"] for r in read_target(spark, target, schema).collect()]
    assert sorted(loaded) == sorted({r[1] for r in rows})
    upsert_increment(read_stream(spark, inbox, schema), versions, "code", str(tmp_path / "cpv"), score, ["i"])
    want = keep_best(spark.createDataFrame(rows, schema), "code", score, ["i"]).orderBy("code").collect()
    now = lambda path: current_rows(spark, path, schema, "code", score, ["i"]).orderBy("code").collect()
    assert now(versions) == want
    compact(spark, versions, smaller, schema, "code", score, ["i"])
    assert now(smaller) == want


def test_layout_spreads_a_hot_value(spark, tmp_path):
    rows = spark.range(20000).withColumn("k", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")))
    write_layout(rows, "k", str(tmp_path / "l"), partitions=6)
    sizes = spark.read.parquet(str(tmp_path / "l")).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) < 8000
    assert spark.read.parquet(str(tmp_path / "l")).count() == 20000


def test_one_copy_serves_two_columns(spark, tmp_path):
    """A value of either column lies inside the bounds of few files."""
    rows = spark.range(40_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000))).alias("a"), F.pmod(F.xxhash64(F.col("id") + 7), F.lit(1000)).alias("b"),
        F.when(F.col("id") % 50 > 0, F.col("id")).alias("c"))
    write_clustered(rows, ["a", "b"], str(tmp_path / "z"), partitions=64)
    copy = spark.read.parquet(str(tmp_path / "z"))
    assert copy.count() == 40_000 and copy.exceptAll(rows).isEmpty()
    bounds = copy.groupBy(F.input_file_name()).agg(*[f(c).alias(f"{c}_{f.__name__}") for c in "ab" for f in (F.min, F.max)])
    files = bounds.count()
    assert files >= 48
    for column in "ab":
        for value in (1, 333, 998):
            assert bounds.where((F.col(f"{column}_min") <= value) & (F.col(f"{column}_max") >= value)).count() <= files / 3
    write_clustered(rows.limit(0), ["a", "c"], str(tmp_path / "none"))
    write_clustered(rows, ["c"], str(tmp_path / "nulls"), partitions=4)
    assert spark.read.parquet(str(tmp_path / "nulls")).where("c IS NULL").count() == 800


def test_fingerprints_match_hashlib(spark, tmp_path):
    import hashlib
    contents = {"a.bin": b"x" * 3_000_000, "b.bin": b"hello", "empty.bin": b""}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    rows = fingerprint(spark, str(tmp_path)).collect()
    got = {r["path"].rsplit("/", 1)[1]: (r["file_sha256"], r["file_bytes"]) for r in rows}
    assert got == {n: (hashlib.sha256(d).hexdigest(), len(d)) for n, d in contents.items()}


def test_replace_is_all_or_nothing(spark, tmp_path, database):
    rows = spark.range(3).select(F.col("id"), F.lit("a").alias("t"))
    create_table(spark, database, "x", rows.schema)
    write_table(rows, database, "x", mode="overwrite")
    bad = rows.withColumn("t", F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise("b"))
    with pytest.raises(Exception, match="stop"):
        write_table(bad, database, "x", mode="overwrite")
    assert {r["t"] for r in read_table(spark, database, "x").collect()} == {"a"}
    write_table(rows.select("t", "id"), database, "x")  # columns match by name
    assert read_table(spark, database, "x").count() == 6
    create_database(spark, database)
    assert [(r["column"], r["type"]) for r in snapshot_schema(spark, database).collect()] == [
        ("id", "bigint"), ("t", "string")]
    with pytest.raises(ValueError):
        write_table(rows, database, "x", mode="merge")


def test_bucketed_tables_join_without_a_shuffle(spark, database):
    hot = spark.range(500).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    with pytest.raises(ValueError, match="one value of k"):
        write_bucketed(hot, database, "hot", "k", 64)
    write_bucketed(hot, database, "hot", "k", 64, hot_buckets=float("inf"))
    assert read_table(spark, database, "hot").count() == 500
    write_bucketed(spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("x")), database, "a", "k", 4)
    write_bucketed(spark.range(500).select(F.col("id").alias("k"), F.lit(2).alias("y")), database, "b", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = label(read_table(spark, database, "a"), read_table(spark, database, "b"), {"k": "k"}, {"y": "y"})
        assert joined.where("y = 2").count() == 500
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refused_rows_do_not_show(spark, database):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    create_table(spark, database, "k", rows.schema)
    check = lambda r: gate_unique(r, ["id"], "k")
    write_table(rows, database, "k", mode="overwrite", check=check)
    for mode in ("append", "overwrite"):
        with pytest.raises(GateError):
            write_table(rows.union(rows), database, "k", mode=mode, check=check)
    with pytest.raises(GateError):
        write_table(rows.limit(1), database, "k", check=check, keys=["id"])
    assert sorted(r["id"] for r in read_table(spark, database, "k").collect()) == [1, 2]
