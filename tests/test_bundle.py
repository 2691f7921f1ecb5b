import csv

import pytest
from pyspark.sql import functions as F

from granary import catalog, plans
from granary.__main__ import main
from granary.operators import enrich
from granary.operators.conform import conform, violations
from granary.operators.quality import (
    GateError,
    available_edges,
    gate_load_options,
    gate_not_null,
    gate_unique,
    missing_references,
)
from granary.plans.bundle import LoadError, numbered_source
from granary.sinks.events import field, read_events
from granary.sinks.layout import select_access_paths
from granary.sources import load_bundle, select_tables
from granary.sources.bundle import bundle_sources
from granary.sources.delimited import CORRUPT, InputError, choose_delimiter, read_delimited

TABLES = {
    "food": [["fdc_id", "data_type", "description", "food_category_id", "publication_date"],
             ["1", "branded_food", "Oil, \"best\"", "Oils Edible", "2020-01-02"],
             ["2", "foundation_food", "Apple\nred", "9", "1/2/2020"],
             ["3", "survey_fndds_food", "Pie", "9", ""]],
    "branded_food": [["fdc_id", "gtin_upc", "serving_size"], ["1", "00-12", "30.5"]],
    "foundation_food": [["fdc_id", "NDB_number"], ["2", "0099"]],
    "survey_fndds_food": [["fdc_id", "food_code", "wweia_category_code"], ["3", "71", "1002"]],
    "wweia_food_category": [["wweia_food_category", "wweia_food_category_description"], ["1002", "Pies"]],
    "food_category": [["id", "code", "description"], ["9", "0900", "Fruits"]],
    "nutrient": [["id", "name", "unit_name", "nutrient_nbr", "rank"], ["203", "Protein", "G", "203", "600"]],
    "food_nutrient": [["id", "fdc_id", "nutrient_id", "amount", "derivation_id"],
                      ["1", "1", "203", "1.5", "49"], ["2", "2", "999", ".5", ""], ["3", "7", "203", "2.", ""]],
    "food_nutrient_derivation": [["id", "code", "description"], ["49", "A", "Analytical"]],
    "measure_unit": [["id", "name"], ["1000", "cup"]],
    "food_portion": [["id", "fdc_id", "measure_unit_id", "gram_weight"],
                     ["1", "2", "1000", "150"], ["2", "", "", "1"]],
    "input_food": [["id", "fdc_id", "fdc_id_of_input_food", "gram_weight", "retention_code"],
                   ["1", "3", "2", "80", "10"], ["2", "3", "x", "8", ""]],
    "retention_factor": [["n.gid", "n.code", "n.foodgroupId", "n.description"], ["1", "10", "2", "Baked"]],
    "food_nutrient_conversion_factor": [["id", "fdc_id"], ["5", "2"]],
    "food_calorie_conversion_factor": [["food_nutrient_conversion_factor_id", "protein_value", "fat_value",
                                        "carbohydrate_value"], ["5", "3.3", "8.3", "3.6"]],
    "food_protein_conversion_factor": [["food_nutrient_conversion_factor_id", "value"], ["5", "6.25"]],
    "microbe": [["id", "foodId", "method"], ["1", "2", "plate"]],
    "fndds_derivation": [["derivation code", "derivation description"], ["D", "Given"]],
    "fndds_ingredient_nutrient_value": [["ingredient code", "derivation code"], ["1", "D"]],
}


def write_csv(folder, name, rows):
    with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)


@pytest.fixture
def bundle(tmp_path):
    folder = tmp_path / "bundle"
    folder.mkdir()
    for name, rows in TABLES.items():
        write_csv(folder, name, rows)
    counts = [[f"{n}.csv", len(r) - 1] for n, r in TABLES.items() if n != "nutrient"]
    write_csv(folder, "all_downloaded_table_record_counts",
              [["Table", "Number of Records"], *counts, ["all_downloaded_table_record_counts.csv", 9], ["total", 1]])
    return folder


def test_import_checks_and_joins(spark, bundle, database, tmp_path):
    log = str(tmp_path / "log")
    counts = plans.import_bundle(
        spark, str(bundle), database, log_path=log, log_format="jsonl",
        dictionary="food fdc_id data_type description food_category_id")
    assert {r["table"]: r["rows"] for r in counts.collect()} == {n: len(r) - 1 for n, r in TABLES.items()}
    t = {n: spark.table(f"{database}.{n}") for n in TABLES}
    foods = {r["fdc_id"]: r for r in t["food"].collect()}
    assert foods[2]["description"] == "Apple\nred" and str(foods[2]["publication_date"]) == "2020-01-02"
    assert foods[1]["description"] == 'Oil, "best"' and foods[3]["publication_date"] is None
    assert t["retention_factor"].columns == ["n_gid", "n_code", "n_foodgroupid", "n_description"]

    missing = {r["edge"]: r["missing_rows"] for r in missing_references(
        t, available_edges(t, catalog.ALL_EDGES)).collect()}
    assert missing["food_nutrient.fdc_id -> food.fdc_id"] == 1
    assert missing["food_nutrient.nutrient_id -> nutrient.id"] == 1
    assert missing["food_portion.fdc_id -> food.fdc_id"] == 1
    assert missing["input_food.fdc_id_of_input_food -> food.fdc_id"] == 1
    assert missing["survey_fndds_food.wweia_category_code -> wweia_food_category.wweia_food_category"] == 0
    known = {r["edge"]: r["missing_rows"] for r in missing_references(t, catalog.CHECKED_EDGES, ignore_null=True).collect()}
    assert known["food_portion.measure_unit_id -> measure_unit.id"] == 0

    one = lambda df, where: df.where(where).first().asDict()
    named = one(enrich.labelled_nutrients(t), "id = 1")
    assert (named["nutrient_name"], named["nutrient_unit"], named["derivation_code"]) == ("Protein", "G", "A")
    assert enrich.nutrients_of(t, 1).count() == 1
    assert [r["measure_unit"] for r in enrich.portions_of(t, 2).collect()] == ["cup"]
    extended = enrich.extended_foods(t)
    assert one(extended, "fdc_id = 2")["foundation_food_ndb_number"] == "0099"
    assert one(extended, "fdc_id = 3")["survey_fndds_food_food_code"] == "71"
    factors = one(enrich.conversion_factors(t), "fdc_id = 2")
    assert (factors["fat_value"], factors["nitrogen_value"]) == (8.3, 6.25)
    meal = one(enrich.meal_components(t), "id = 1")
    assert (meal["composite"], meal["ingredient"], meal["retention"]) == ("Pie", "Apple\nred", "Baked")
    assert one(enrich.meal_components(t), "id = 2")["ingredient"] is None
    assert one(enrich.categorised_surveys(t), "fdc_id = 3")["category"] == "Pies"
    assert [r["category"] for r in enrich.categorised_foods(t).orderBy("fdc_id").collect()] == [
        "Oils Edible", "Fruits", "Fruits"]
    assert enrich.food_microbes(t).first()["description"] == "Apple\nred"
    assert enrich.decoded_ingredient_values(t).first()["derivation_description"] == "Given"
    products = spark.createDataFrame([("0012", "Oil", "B"), ("", "none", "")], "code_norm string, product_name string, brands string")
    assert enrich.cross_source_matches(t["branded_food"], products).first()["product_name"] == "Oil"

    events = read_events(spark, log)
    names = [r["event"] for r in events.orderBy("ts", F.col("event") == "run_done", F.col("event") != "run_start").collect()]
    assert names[0] == "run_start" and names[-1] == "run_done" and names.count("table_done") == len(TABLES)
    assert set(names) <= set(catalog.BUNDLE_EVENTS)
    assert events.where(F.col("event") == "dictionary_miss_headers").where(field("table") == "food").select(field("missing_headers")).first()[0] == "1"
    assert events.where("event = 'dictionary_miss_table'").count() == len(TABLES) - 1

    written = plans.layout_tables(spark, database, str(tmp_path / "layout"), skip=["food-description-idx"], partitions=2,
                                  log_path=log, log_format="jsonl")
    assert len(written) == len(catalog.ACCESS_PATHS) - 1
    by_code = spark.read.parquet(written["branded_food_gtin_upc_idx"])
    found = enrich.lookup(by_code, "gtin_upc", "00-12")
    assert found.count() == 1
    assert "EqualTo(gtin_upc,00-12)" in found._jdf.queryExecution().executedPlan().toString()
    plans.snapshot_text(spark, database, str(tmp_path / "ddl"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "ddl")).collect())
    assert text.count("CREATE TABLE") == len(TABLES) and text.index(".branded_food") < text.index(".nutrient")


def test_bad_cells_name_the_first_record(spark, bundle, database):
    rows = [["id", "name"]] + [[str(i), "x"] for i in range(50)]
    rows[30][0], rows[40][0], rows[20][1] = "+5", "z", "quoted\nbreak"
    write_csv(bundle, "measure_unit", rows)
    with pytest.raises(LoadError, match=r"record 31 column id: invalid bigint '\+5'"):
        plans.import_bundle(spark, str(bundle), database, only=["measure unit"])
    rows[10] = ["7"]
    write_csv(bundle, "measure_unit", rows)
    with pytest.raises(LoadError, match="record 11 column _corrupt: width '7'"):
        plans.import_bundle(spark, str(bundle), database, only=["measure unit"])
    assert spark.table(f"{database}.measure_unit").count() == 0
    source = bundle_sources(spark, str(bundle), only=["measure_unit"])[0]
    raw = numbered_source(spark, source)
    bad = violations(raw, source.schema, ["record_number"]).orderBy("record_number").collect()
    assert [(r["record_number"], r["reason"]) for r in bad] == [(11, "width"), (31, "invalid bigint"), (41, "invalid bigint")]
    assert conform(raw, source.schema, on_error="quarantine").count() == 47
    with pytest.raises(Exception, match="invalid bigint|wrong width"):
        conform(raw, source.schema).write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        conform(raw, source.schema, on_error="ignore")


def test_cells_keep_blanks_only_in_text(spark, bundle, database):
    write_csv(bundle, "nutrient", [["id", "name", "rank"], [" 1 ", "  a ", " "]])
    with pytest.raises(LoadError, match="column rank: invalid double ''"):
        plans.import_bundle(spark, str(bundle), database, only=["nutrient"])
    write_csv(bundle, "nutrient", [["id", "name", "rank"], [" 1 ", "  a ", "1e-2"], ["2", "", ""]])
    plans.import_bundle(spark, str(bundle), database, only=["nutrient"], drop=True)
    rows = spark.table(f"{database}.nutrient").orderBy("id").collect()
    assert rows == [(1, "  a ", 0.01), (2, None, None)]
    (bundle / "nutrient.csv").write_bytes(b"id,name\n1,a\x00b\n")
    with pytest.raises(LoadError, match="column name: nul"):
        plans.import_bundle(spark, str(bundle), database, only=["nutrient"], drop=True)


def test_resume_and_reconcile(spark, bundle, database, tmp_path):
    load = lambda **o: plans.import_bundle(spark, str(bundle), database, only=["food", "nutrient"], **o)
    load()
    rows = TABLES["food"] + [["4", "branded_food", "New", "", ""]]
    write_csv(bundle, "food", rows)
    with pytest.raises(GateError, match="nutrient: key id"):
        load(check_keys=True)  # a second full load repeats keys
    assert spark.table(f"{database}.nutrient").count() == 1
    load(truncate=True)
    assert spark.table(f"{database}.food").count() == 4
    write_csv(bundle, "food", rows + [["5", "branded_food", "Newer", "", ""]])
    log = str(tmp_path / "log")
    plans.import_bundle(spark, str(bundle), database, only=["food"], resume=True, log_path=log, log_format="jsonl")
    assert sorted(r["fdc_id"] for r in spark.table(f"{database}.food").collect()) == [1, 2, 3, 4, 5]
    events = {r["event"]: dict(r["fields"]) for r in read_events(spark, log).collect()}
    assert events["expected_rows_mismatch"]["csv_rows"] == "5" and events["table_resume"]["existing_rows"] == "4"
    plans.import_bundle(spark, str(bundle), database, only=["food"], resume=True, log_path=log, log_format="text")
    assert spark.table(f"{database}.food").count() == 5
    write_csv(bundle, "food", TABLES["food"])
    with pytest.raises(GateError, match="has 5 rows, its file only 3"):
        plans.import_bundle(spark, str(bundle), database, only=["food"], resume=True)
    rates = plans.import_bundle(spark, str(bundle), database, only=["food"], drop=True, benchmark=True).first()
    assert rates["selected_rows"] == 3 and rates["bundle_rows"] > 3 and rates["full_seconds_by_bytes"] > 0
    with pytest.raises(GateError):
        gate_load_options(resume=True, drop=False, truncate=True)


def test_selection():
    names = ["a", "b_c", "d"]
    assert select_tables(names) == names
    assert select_tables(names, ["D", "b c", "d"]) == ["d", "b_c"]
    assert select_tables(names, ["D", "b c"], ["d"]) == ["b_c"]
    with pytest.raises(ValueError):
        select_tables(names, ["x"])
    assert [p.name for p in select_access_paths(["Food-FDC-id-idx"])] == ["food_fdc_id_idx"]
    with pytest.raises(ValueError):
        select_access_paths(skip=[p.name for p in catalog.ACCESS_PATHS])


def test_bundle_frames_and_empty_files(spark, bundle):
    frames = load_bundle(spark, str(bundle), only=["food", "nutrient"])
    assert list(frames) == ["food", "nutrient"] and frames["food"].count() == 3
    (bundle / "empty.csv").write_text("")
    with pytest.raises(InputError, match="empty"):
        load_bundle(spark, str(bundle), only=["empty"])


def test_delimiters():
    assert choose_delimiter("a,b,c") == (",", ",")
    assert choose_delimiter("a\tb,c\td") == ("\t", "\t")
    assert choose_delimiter("a,b\tc") == ("\t", "\t")
    assert choose_delimiter("abc") == ("\t", "\t")
    assert choose_delimiter("a,b,c", ";") == (";", ",")


def test_quoting_matches_python(spark, tmp_path):
    rows = [["id", "t"], ["1", 'say "hi"'], ["2", 'in"ner'], ["3", "back\\\"slash"], ["4", "two\nlines"], ["5", " pad "],
            ["6", ""], ["7", "tab\there"]]
    write_csv(tmp_path, "q", rows)
    read = read_delimited(spark, str(tmp_path / "q.csv"), sep=",", strict=True)
    assert [[r["id"], r["t"] or ""] for r in read.orderBy("id").collect()] == rows[1:]
    assert read.where(F.col(CORRUPT).isNotNull() & F.col("id").isNotNull()).count() == 0


def test_blank_lines_and_field_size(spark, tmp_path):
    (tmp_path / "b.csv").write_text("a,b\n1,2\n\n3,4\n")
    with pytest.raises(InputError, match="blank"):
        read_delimited(spark, str(tmp_path / "b.csv"), sep=",", strict=True)
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path / "b.csv")).collect()] == [("1", "2"), ("", ""), ("3", "4")]
    (tmp_path / "big.csv").write_text("a,b\n1," + "x" * 500 + "\n")
    assert read_delimited(spark, str(tmp_path / "big.csv"), max_chars=500).first()["b"] == "x" * 500
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path / "big.csv"), max_chars=100).collect()
    for i in (1, 2):
        (tmp_path / f"h{i}.csv").write_text(f"a{i},b\n1,2\n")
    with pytest.raises(InputError, match="another header"):
        read_delimited(spark, str(tmp_path / "h*.csv"))


def test_gates(spark):
    rows = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    with pytest.raises(GateError):
        gate_unique(rows, ["a"], "t")
    with pytest.raises(GateError):
        gate_not_null(rows, ["a", "b"], "t")
    gate_unique(rows, ["a", "b"], "t")


def test_command_line(spark, bundle, tmp_path, database, capsys):
    main(["layout", "--list", "--only", "food_fdc_id_idx"])
    assert capsys.readouterr().out.strip() == "food_fdc_id_idx"
    main(["import-bundle", "--csv-dir", str(bundle), "--schema", database, "--only", "nutrient"])
    assert "nutrient" in capsys.readouterr().out
    main(["snapshot", "--schema", database, "--output", str(tmp_path / "ddl")])


def test_verify_reports_problems(spark, bundle, database, tmp_path):
    plans.import_bundle(spark, str(bundle), database, drop=True)
    log = str(tmp_path / "verify-log")
    rows = {(r["check"], r["subject"]): r["problems"] for r in plans.verify_database(spark, database, log_path=log, log_format="jsonl").collect()}
    assert rows["unique", "nutrient.id"] == 0 and rows["filled", "nutrient.id"] == 0
    assert {k for k, _ in rows} == {"unique", "filled", "reference"}
    assert read_events(spark, log).count() == len(rows)
    spark.sql(f"INSERT INTO {database}.nutrient SELECT * FROM {database}.nutrient WHERE id = 203")
    again = {(r["check"], r["subject"]): r["problems"] for r in plans.verify_database(spark, database).collect()}
    assert again["unique", "nutrient.id"] == 1


def test_tables_load_side_by_side(spark, bundle, database, tmp_path, monkeypatch):
    """Loads overlap, a table may be a folder of files, and one bad cell stops all."""
    from threading import Barrier

    from granary.plans import bundle as plan

    names, log = ["food", "nutrient", "measure_unit", "microbe"], str(tmp_path / "log")
    both, load = Barrier(2), plan.load_table

    def meeting(*args, **options):
        both.wait(60)  # an error unless another load runs at the same time
        load(*args, **options)

    (bundle / "nutrient.csv").unlink()
    (bundle / "nutrient.csv").mkdir()
    for part in ("1", "2"):
        write_csv(bundle / "nutrient.csv", f"part-{part}", [["id", "name"], [part, "x"]])
    monkeypatch.setattr(plan, "load_table", meeting)
    counts = plans.import_bundle(spark, str(bundle), database, only=names, at_once=2, log_path=log, log_format="jsonl")
    assert {r["table"]: r["rows"] for r in counts.collect()} == {"food": 3, "nutrient": 2, "measure_unit": 1, "microbe": 1}
    events = [r["event"] for r in read_events(spark, log).collect()]
    assert events.count("table_start") == events.count("table_done") == 4

    monkeypatch.setattr(plan, "load_table", load)
    write_csv(bundle, "food", [*TABLES["food"], ["z", "", "", "", ""]])
    failing = str(tmp_path / "failing")
    with pytest.raises(LoadError, match="column fdc_id: invalid bigint 'z'"):
        plans.import_bundle(spark, str(bundle), database, only=names, drop=True, at_once=2, log_path=failing, log_format="jsonl")
    events = [r["event"] for r in read_events(spark, failing).collect()]
    assert events.count("table_error") == 1 and "run_done" not in events
    rows = {n: spark.table(f"{database}.{n}").count() for n in names}
    assert rows["food"] == 0 and rows["nutrient"] in (0, 2) and rows["measure_unit"] in (0, 1)


def test_first_error_cancels_the_other_loads(spark):
    import time

    started, seen = [], []

    def fail():
        time.sleep(3)
        raise ValueError("bad cell")

    def long():
        spark.range(0, 10**13, 1, 8).select(F.max(F.xxhash64("id"))).write.format("noop").mode("overwrite").save()

    begun = time.time()
    with pytest.raises(ValueError, match="bad cell"):
        plans.bundle.side_by_side(
            spark, {"a": fail, "b": long, "c": lambda: started.append("c")}, 2, lambda table, error: seen.append((table, str(error))))
    assert seen == [("a", "bad cell")] and not started and time.time() - begun < 60
