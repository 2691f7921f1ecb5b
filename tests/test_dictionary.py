import random

from granary.operators.quality import dictionary_coverage, mentioned


def test_mentions_against_a_search(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcé ") for _ in range(20_000))
    tokens = {text[i : i + rnd.randint(1, 30)] for i in range(0, 20_000, 700)} | {"", text[4090:4103], text[-5:], text[:3], text + "x"}
    tokens |= {"".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 9))) for _ in range(200)}
    frame = spark.createDataFrame([(t,) for t in tokens] + [(None,)], "t string")
    got = mentioned(frame, spark.createDataFrame([(text,), (None,)], "_text string")).collect()
    assert sorted(r[0] for r in got) == sorted(t for t in tokens if t and t in text)


def test_coverage_of_odd_rows(spark):
    rows = spark.createDataFrame([("food", "fdc id"), ("foo", " "), ("foo", "d x"), (None, "none")], "`table` string, header string")
    found = {(r["table"], r.header): (r.table_found, r.header_found) for r in dictionary_coverage(rows, "food fdc\u00a0id x").collect()}
    assert found == {("food", "fdc id"): (True, True), ("foo", "d x"): (False, True), (None, "none"): (False, False)}
    assert dictionary_coverage(rows, "").where("table_found OR header_found").count() == 0
