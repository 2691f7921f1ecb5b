"""Records across byte ranges, against Python's csv reader."""

import csv
import random

import pytest
from granary.session import stage
from granary.sources.delimited import CORRUPT, SOURCE_ORDER, InputError, read_delimited, record_numbers
from granary.sources.records import line_patterns, read_lines, summarize, with_starts
from pyspark.sql import functions as F


def expected(path, width, sep=","):
    with open(path, newline="", encoding="utf-8") as f:
        return [[*r, *[""] * width][:width] for r in list(csv.reader(f, delimiter=sep))[1:]]


def odd_rows(rnd, n):
    cells = ["plain", '"quoted"', '"two\nlines"', '"a ""b"" c"', '"tail" here', 'in"ner', "", '"x\n\ny"', '"cr\r\nlf"', '"""', '"sep,in"', 'é"']
    lines = ["id,a,b"]
    for i in range(n):
        if rnd.random() < 0.1:
            lines.append("")
            continue
        row = [str(i), rnd.choice(cells), rnd.choice(cells)]
        if '"""' in row:  # opens a cell that a later quote closes
            row = [str(i), '"" "', "z"]
        lines.append(",".join(row[: rnd.choice([3, 3, 3, 2])]) + ("\r" if rnd.random() < 0.1 else ""))
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", range(2))
def test_ranges_of_any_size_give_the_same_records(spark, tmp_path, seed):
    rnd = random.Random(seed)
    path = tmp_path / "odd.csv"
    path.write_bytes(odd_rows(rnd, 120).encode())
    want = expected(path, 3)
    try:
        for size in ("37b", "500b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = stage(read_delimited(spark, str(path), sep=",", columns=["id", "a", "b"], with_order=True), "odd")
            rows = record_numbers(read).orderBy("record_number").collect()
            assert [[r.id, r.a, r.b] for r in rows] == want
            assert [r.record_number for r in rows] == list(range(2, len(want) + 2))
            if size == "37b":
                assert read.select(*SOURCE_ORDER[:2]).distinct().count() > 30
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_states_of_ranges(spark, tmp_path):
    text = 'a,b\n1,"x\ny\nz\n",2\n\n3,"q"\n4,"\n\n"\n'
    (tmp_path / "s.csv").write_text(text)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "6b")
        lines = read_lines(spark, str(tmp_path / "s.csv"))
        rows = {r.block: r for r in with_starts(summarize(lines, ",", "a,b")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    begins, inside, at = {}, False, 0
    for line in text.splitlines(keepends=True):
        begins[at] = inside
        inside ^= line.count('"') % 2 == 1
        at += len(line)
    for block, r in rows.items():
        first = min(b for b in begins if b > block or not block)  # a line at a border is read by the range before
        assert r.start == begins[first], block
    blank = sum(r.blank1 if r.start else r.blank0 for r in rows.values())
    assert blank == 1 and sum(r.lines for r in rows.values()) == text.count("\n")


def test_patterns(spark):
    """Random lines: which end a record, begun outside or inside quotes, by the states of Python's reader."""
    rnd = random.Random(3)
    lines = ["".join(rnd.choice('",ab"') for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    frame = spark.createDataFrame([(x,) for x in lines], "v string")
    ends = lambda *before: lambda x: list(csv.reader([*before, x + "\n", "Z,Z\n"]))[-1] == ["Z", "Z"]
    for r in frame.select("v", *[F.col("v").rlike(p) for p in line_patterns(",")]).collect():
        assert list(r)[1:3] == [ends()(r.v), ends('"\n')(r.v)], r.v
        if r[3]:
            assert r[1] and next(csv.reader([r.v]), []) == [x[1:-1].replace('""', '"') if x[:1] == '"' else x for x in split_plain(r.v)], r.v
    frame = spark.createDataFrame([('a,"b\rc',), ('a\r"b',), ('a\r"b"',)], "v string")
    assert [list(r) for r in frame.select(*[F.col("v").rlike(p) for p in line_patterns(",")[:2]]).collect()] == [[False, True], [False, True], [True, True]]


def split_plain(line):
    cells, cell, inside = [], "", False
    for c in line:
        inside ^= c == '"' and (inside or not cell or cell[0] == '"')
        if c == "," and not inside:
            cells, cell = [*cells, cell], ""
        else:
            cell += c
    return [*cells, cell] if line else []


def test_blank_records_in_every_kind_of_file(spark, tmp_path):
    body = {"plain.csv": "a,b\n1,2\n\n3,4\n\n", "quoted.csv": 'a,b\n1,"x\n\ny"\n\n3,4\n'}
    for name, text in body.items():
        path = tmp_path / name
        path.write_text(text)
        read = stage(read_delimited(spark, str(path), with_order=True), "blank")
        assert [[r.a, r.b] for r in record_numbers(read).orderBy("record_number").collect()] == expected(path, 2)
        with pytest.raises(InputError, match="[12] records .* blank"):
            read_delimited(spark, str(path), sep=",", strict=True)
    import gzip

    for k, text in enumerate(body.values()):
        (tmp_path / f"z{k}.csv.gz").write_bytes(gzip.compress(text.encode()))
    rows = read_delimited(spark, str(tmp_path / "*.gz")).collect()
    assert sorted([r.a, r.b] for r in rows) == sorted(expected(tmp_path / "plain.csv", 2) + expected(tmp_path / "quoted.csv", 2))
    strict = read_delimited(spark, str(tmp_path / "*.gz"), sep=",", strict=True)
    assert strict.where(F.col(CORRUPT) == "").count() == 3 and strict.where(F.col(CORRUPT).isNull()).count() == 4


def test_wrong_widths_keep_their_text(spark, tmp_path):
    (tmp_path / "w.csv").write_text('a,b\n1,"x\ny",3\n1\n"p" q,2\n')
    rows = read_delimited(spark, str(tmp_path / "w.csv"), sep=",", strict=True).collect()
    assert [(r.a, r.b, r[CORRUPT]) for r in rows] == [("1", "x\ny", '1,"x\ny",3'), ("1", None, "1"), ("p q", "2", None)]


def test_broken_bytes_and_unclosed_quotes(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes(b'a,b\n1,\xff\n2,"open\nrest')
    with pytest.raises(InputError, match="UTF-8"):
        read_delimited(spark, str(tmp_path / "u.csv"), sep=",")
    rows = read_delimited(spark, str(tmp_path / "u.csv"), sep=",", encoding_errors="replace").collect()
    assert [r.b.rstrip("\n") for r in rows] == ["�", "open\nrest"]
