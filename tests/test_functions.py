import pytest
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary import catalog
from granary.functions import (
    column_type,
    digits_key,
    drop_nul,
    escape_text,
    infer_schema,
    lenient_double,
    lenient_long,
    normalize_identifier,
    normalize_layout_name,
    primary_key,
    strict_date,
    strict_double,
    strict_long,
    strip,
)
from granary.functions.rules import column_type_name, identifier, primary_key_names, unique_identifiers
from granary.operators.dedupe import numbered_repeats, unique_identifier_rows

SPACES = ["", " ", "\t", "\x1c", "\x1f", "\xa0", " ", "　", "\n", "\x85"]


def column(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_and_digits_match_python(spark):
    picks = random.Random(1)
    alphabet = SPACES + list("a1-²③٣५") + ["⑴", "\U0001f101", "\U00010a41", "½", "Ⅷ"]
    values = ["".join(picks.choices(alphabet, k=picks.randrange(9))) for _ in range(400)]
    values += [chr(c) for c in range(0x20, 0x3000) if c not in (0xD800,)] + [chr(c) for c in range(0x10A00, 0x11100)]
    assert column(spark, values, strip) == [v.strip() for v in values]
    assert column(spark, values, digits_key) == ["".join(c for c in v if c.isdigit()) for v in values]
    assert column(spark, [" 00-12 ", "abc", ""], digits_key) == ["0012", "", ""]


def test_identifiers(spark):
    raw = ["n.code", "1st", " ", "﻿ id", "A--b__C.", "a﻿b", "Größe (g)", "fdc_id", "_x_"]
    want = ["n_code", "c_1st", "col", "id", "a_b_c", "ab", "gr_e_g", "fdc_id", "x"]
    assert column(spark, raw, normalize_identifier) == want
    assert [identifier(r) for r in raw] == want
    assert unique_identifiers(["a", "a", "b"]) == ["a", "a_2", "b"]
    with pytest.raises(ValueError, match="a_2"):
        unique_identifiers(["A", "a", "a_2"])
    assert column(spark, [" Food-Idx "], normalize_layout_name) == ["food_idx"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aA1 ._-", max_size=4), max_size=12))
def test_unique_identifiers_are_numbered(names):
    bases = [identifier(n) for n in names]
    numbered = [b if (n := bases[: i + 1].count(b)) == 1 else f"{b}_{n}" for i, b in enumerate(bases)]
    if len(set(numbered)) < len(numbered):
        with pytest.raises(ValueError, match="share a name"):
            unique_identifiers(names)
        return
    out = unique_identifiers(names)
    for i, base in enumerate(bases):
        n = bases[: i + 1].count(base)
        assert out[i] == (base if n == 1 else f"{base}_{n}")


def test_unique_identifier_rows_match_the_list_form(spark):
    names = ["a", "A", "b c", "a", "", "b.c", "a"] * 5
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, raw string")
    rows = rows.withColumn("ident", normalize_identifier(F.col("raw"))).repartition(5)
    got = unique_identifier_rows(rows, "ident", "pos").orderBy("pos").collect()
    assert [r["ident"] for r in got] == unique_identifiers(names)


def test_numbered_repeats_over_many_pieces(spark):
    rows = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")))
    got = numbered_repeats(rows, ["k"], "id", piece_rows=16).orderBy("id").collect()
    seen = {}
    for r in got:
        seen[r["k"]] = seen.get(r["k"], 0) + 1
        assert r["n"] == seen[r["k"]]


def test_strict_casts(spark):
    raw = ["5", " -7 ", "+5", "1e+5", "5.", ".5", "1d", "1_000", "nan", "inf", "1e5", "1E-2", "  ", "", "-", ".", "0x1", "99999999999999999999"]
    ints = [int(v) if re.match(r"^-?[0-9]+$", v.strip()) and len(v) < 20 else None for v in raw]
    assert column(spark, raw, strict_long) == ints == column(spark, raw, lenient_long)
    assert column(spark, raw, strict_double) == [
        5.0, -7.0, None, None, 5.0, 0.5, None, None, None, None, 1e5, 0.01, None, None, None, None, None, 1e20]
    dates = ["2020-01-02", "1/2/2020", " 12/31/2020 ", "2020-02-30", "13/1/2020", "Jan 2", "1/2/20", "2020-1-2", ""]
    assert [str(d) if d else None for d in column(spark, dates, strict_date)] == [
        "2020-01-02", "2020-01-02", "2020-12-31", None, None, None, None, None, None]


def _python_float(text):
    text = text.strip()
    try:
        return float(text) if text.isascii() and "_" not in text else None
    except ValueError:
        return None


def test_lenient_double_matches_python(spark):
    picks = random.Random(2)
    values = ["".join(picks.choices("0123456789+-.eE dxf", k=picks.randrange(7))) for _ in range(3000)]
    values += ["inf", "-Infinity", "+INF", "nan", "-NaN", "+nan", "infinit", " 1e5 ", "1\x1c", "\x1f2", "1_0", "5\x01"]
    got = column(spark, values, lenient_double)
    want = [_python_float(v) for v in values]
    same = [(g == w) or (g is not None and w is not None and g != g and w != w) for g, w in zip(got, want, strict=True)]
    assert all(same), [(v, g, w) for v, g, w, s in zip(values, got, want, same, strict=True) if not s][:5]
    assert column(spark, ["\xa05　"], lenient_double) == [5.0]


def test_escape(spark):
    raw = "a\\b\tc\nd\re\bf\fg\vh\x00i"
    assert column(spark, [raw], escape_text) == ["a\\\\b\\tc\\nd\\re\\bf\\fg\\vhi"]
    assert column(spark, [None], lambda c: escape_text(c, "\\N")) == ["\\N"]
    assert column(spark, ["\x00a\x00"], drop_nul) == ["a"]


def test_rules_agree_in_both_forms(spark):
    names = sorted({*catalog.DATE_COLUMNS, *catalog.DOUBLE_COLUMNS, *catalog.LONG_COLUMNS, *catalog.ID_COLUMNS,
                    *catalog.TEXT_COLUMNS, "food_category_id", "x_date", "x_id", "x_code", "x_number", "plain"})
    pairs = [(t, n) for t in ("food", "food_nutrient") for n in names]
    frame = spark.createDataFrame(pairs, "t string, n string").select("*", column_type(F.col("t"), F.col("n")).alias("k"))
    assert all(r["k"] == column_type_name(r["t"], r["n"]) for r in frame.collect())
    tables = [*catalog.TABLE_KEYS, *catalog.ONE_ROW_PER_FOOD, "food", "retention_factor"]
    lists = [["id", "fdc_id"], ["fdc_id"], ["fdc_id", "x"], ["x"], ["fdc_id", "acquisition_number"],
             ["food_nutrient_conversion_factor_id", "value"]]
    cases = [(t, c) for t in tables for c in lists]
    keys = spark.createDataFrame(cases, "t string, c array<string>").select(
        "*", primary_key_names(F.col("t"), F.col("c")).alias("k"))
    assert all(r["k"] == ",".join(primary_key(r["t"], r["c"])) for r in keys.collect())


def test_schema_of_known_tables():
    kinds = lambda t, c: [f.dataType.simpleString() for f in infer_schema(t, c)]
    assert kinds("food", ["fdc_id", "data_type", "description", "food_category_id", "publication_date"]) == [
        "bigint", "string", "string", "string", "date"]
    assert kinds("input_food", ["fdc_id_of_input_food", "gram_weight", "seq_num", "retention_code"]) == [
        "string", "double", "bigint", "string"]
    assert primary_key("food", ["fdc_id", "data_type"]) == []
    assert primary_key("sample_food", ["fdc_id"]) == ["fdc_id"]
    assert primary_key("market_acquisition", ["fdc_id", "acquisition_number"]) == ["fdc_id", "acquisition_number"]
