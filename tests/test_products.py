import gzip
import json

import pytest
from exports import SCORED, TWO_PRODUCTS, write_rows
from pyspark.sql import functions as F

from granary.operators.quality import GateError
from granary.plans import import_products, preflight_products
from granary.plans.products import load_products
from granary.sources.delimited import InputError, read_delimited
from granary.sources.manifest import ManifestError, read_manifest


def preflight(spark, path, tmp_path, **options):
    out = str(tmp_path / "manifest")
    return out, preflight_products(spark, path, out, **options).first()


@pytest.mark.parametrize("sep,bom", [("\t", False), ("\t", True), (",", False)])
def test_two_products(spark, tmp_path, database, sep, bom):
    path = write_rows(tmp_path / "in.csv", TWO_PRODUCTS, sep, bom)
    manifest, row = preflight(spark, path, tmp_path)
    assert (row["code_total"], row["duplicates_found"]) == (2, False)
    totals = import_products(spark, path, database, preflight_manifest=manifest).first()
    assert (totals["products"], totals["nutrients"]) == (2, 6)
    rows = spark.table(f"{database}.product_raw").orderBy("code_norm").collect()
    assert [r["code_norm"] for r in rows] == ["00731", "00732"]
    assert rows[0]["protein_100g"] == 0.9 and rows[0]["categories"] == ""
    run = spark.table(f"{database}.import_metadata").collect()
    assert len(run) == 1 and run[0]["delimiter"] == sep and run[0]["nutrients_mode"] == "minimal"


def test_scored_duplicates(spark, tmp_path, database):
    path = write_rows(tmp_path / "dup.tsv", SCORED)
    codes = str(tmp_path / "codes")
    manifest, row = preflight(spark, path, tmp_path, duplicate_codes_out=codes)
    assert (row["code_total"], row["code_unique"]) == (4, 2)
    assert (row["duplicate_values"], row["duplicate_occurrences"]) == (1, 2)
    assert row["duplicate_samples"] == ["00731"] and row["duplicate_codes_count"] == 1
    assert read_manifest(spark, manifest)["duplicate_codes_path"] == codes
    totals = import_products(spark, path, database, preflight_manifest=manifest).first()
    assert (totals["products"], totals["nutrients"], totals["duplicates_resolved"]) == (2, 10, 1)
    won = spark.table(f"{database}.product_raw").where("code_norm = '00731'").first()
    assert won["product_name"] == "complete"
    with pytest.raises(GateError, match="already holds"):
        import_products(spark, path, database, preflight_manifest=manifest)
    again = import_products(
        spark, path, database, preflight_manifest=manifest, truncate=True, nutrients="all",
    ).first()
    assert (again["products"], again["nutrients"]) == (2, 10)
    assert spark.table(f"{database}.product_raw").count() == 2
    assert spark.table(f"{database}.import_metadata").count() == 2


def test_keep_first(spark, tmp_path, database):
    path = write_rows(tmp_path / "dup.tsv", SCORED)
    manifest, _ = preflight(spark, path, tmp_path)
    with pytest.raises(GateError, match="duplicate codes"):
        import_products(spark, path, database, preflight_manifest=manifest)
    totals = import_products(spark, path, database, preflight_manifest=manifest, dedupe="memory").first()
    assert (totals["products"], totals["nutrients"], totals["skipped_duplicate_code"]) == (2, 7, 2)
    names = {r["product_name"] for r in spark.table(f"{database}.product_raw").collect()}
    assert names == {"oldest", "single"}


def test_repeated_codes_break_the_key(spark, tmp_path, database):
    path = write_rows(tmp_path / "dup.tsv", SCORED)
    _, row = preflight(spark, path, tmp_path)
    with pytest.raises(GateError, match="occurs 3 times"):
        import_products(spark, path, database, expected_sha256=row["file_sha256"])
    with pytest.raises(GateError, match="expected: sha-256 mismatch"):
        import_products(spark, path, database, expected_sha256="abc")
    with pytest.raises(GateError, match="give the expected"):
        import_products(spark, path, database)


def _manifest(tmp_path, text):
    path = tmp_path / "m.json"
    path.write_text(text if isinstance(text, str) else json.dumps(text))
    return str(path)


def test_manifest_gates(spark, tmp_path, database):
    path = write_rows(tmp_path / "in.tsv", TWO_PRODUCTS)
    out, row = preflight(spark, path, tmp_path)
    good = read_manifest(spark, out)
    assert good["format_version"] == 1 and good["skipped_no_code"] == 0
    assert set(good) >= {"created_at", "sort_seconds", "detected_delimiter", "duplicate_codes_path"}

    def load(document):
        return import_products(
            spark, path, database, preflight_manifest=_manifest(tmp_path, document), truncate=True
        ).first()

    for bad, error in [
        ("{invalid json", "not a JSON object"), (["not", "a", "dict"], "not a JSON object"),
        ({**good, "file_bytes": "not_an_int"}, "file_bytes is not a bigint"),
        ({**good, "duplicates_found": "not_a_bool"}, "duplicates_found is not a boolean"),
    ]:
        with pytest.raises(ManifestError, match=error):
            load(bad)
    for field in ("file_sha256", "file_bytes", "duplicates_found"):
        with pytest.raises(GateError, match=f"without {field}"):
            load({k: v for k, v in good.items() if k != field})
    for change in ({"file_sha256": "0"}, {"file_bytes": 1}, {"duplicates_found": "TRUE"},
                   {"duplicate_values": 3}):
        with pytest.raises(GateError):
            load({**good, **change})
    assert load({**good, "duplicates_found": " False ", "file_bytes": str(good["file_bytes"])})["products"] == 2
    with pytest.raises(ManifestError, match="no manifest"):
        import_products(spark, path, database, preflight_manifest=str(tmp_path / "absent.json"))


def test_lists_relative_to_the_manifest_and_exclusive_options(spark, tmp_path, database):
    path = write_rows(tmp_path / "dup.tsv", SCORED)
    out, _ = preflight(spark, path, tmp_path)
    (tmp_path / "mine.txt").write_text(" 00731 \n\n00731\n")
    document = {**read_manifest(spark, out), "duplicate_codes_path": "mine.txt"}
    manifest = _manifest(tmp_path, document)
    assert import_products(spark, path, database, preflight_manifest=manifest).first()["duplicates_resolved"] == 1
    with pytest.raises(GateError, match="not both"):
        import_products(spark, path, database, preflight_manifest=manifest, dedupe="memory",
                        duplicate_codes=str(tmp_path / "mine.txt"))
    # a list named by the manifest does not exclude keeping the first row
    totals = import_products(spark, path, database, preflight_manifest=manifest, dedupe="memory", truncate=True).first()
    assert (totals["products"], totals["nutrients"]) == (2, 7)
    assert (totals["duplicates_resolved"], totals["skipped_duplicate_code"]) == (1, 2)


def test_energy_text_and_gzip(spark, tmp_path):
    rows = [
        ["code", "energy-kj_100g", "energy_100g", "salt_100g"],
        ["1", "abc", "400", "1"], ["2", "10", "20", "x"], ["3", "", "30", ""], ["4", "", "+1e+2", " 2 "],
        ["abc", "1", "2", "3"], ["5"], ["6", "1", "", "nan", "extra"],
    ]
    path = tmp_path / "e.tsv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("".join("\t".join(r) + "\n" for r in rows))
    raw = read_delimited(spark, str(path), with_order=True)
    load = load_products(spark, raw)
    wide = {r["code_norm"]: r["energy_kj_100g"] for r in load.products.collect()}
    assert wide == {"1": 400.0, "2": 10.0, "3": 30.0, "4": 100.0, "5": None, "6": 1.0}
    assert {r["salt_100g"] for r in load.products.collect()} == {None}
    long = {(r["code_norm"], r["source_field"]): r["value"] for r in load.nutrients.collect()}
    assert long == {("2", "energy-kj_100g"): 10.0, ("3", "energy_100g"): 30.0, ("4", "energy_100g"): 100.0,
                    ("6", "energy-kj_100g"): 1.0}
    every = load_products(spark, raw, nutrients="all")
    assert every.nutrients.where("code_norm = '1'").select("nutrient_key", "unit").collect() == [
        ("energy", "kJ"), ("salt", "")]
    salted = load_products(spark, raw, include_salt=True).products
    assert salted.where("code_norm = '4'").first()["salt_100g"] == 2.0
    assert salted.where(F.isnan("salt_100g")).count() == 1


def test_row_cap_reads_no_further(spark, tmp_path, database):
    rows = [["code", "product_name", "last_modified_t"]]
    rows += [[str(i % 7 if i % 2 else 100 + i), f"p{i}", str(i)] for i in range(40)]
    path = write_rows(tmp_path / "cap.tsv", rows)
    codes = str(tmp_path / "codes")
    manifest, _ = preflight(spark, path, tmp_path, duplicate_codes_out=codes)
    listed = {c for c in (r[0] for r in rows[1:]) if sum(r[0] == c for r in rows[1:]) > 1}
    kept, best = [], {}
    for code, name, modified in rows[1:]:
        if len(kept) >= 6:
            break
        if code in listed:
            if code not in best or int(modified) > best[code][1]:
                best[code] = (name, int(modified))
        else:
            kept.append(name)
    expected = set(kept) | {name for name, _ in best.values()}
    import_products(spark, path, database, preflight_manifest=manifest, max_rows=6)
    assert {r["product_name"] for r in spark.table(f"{database}.product_raw").collect()} == expected
    import_products(spark, path, database, expected_sha256=read_manifest(spark, manifest)["file_sha256"],
                    max_rows=6, dedupe="best", truncate=True)
    assert {r["product_name"] for r in spark.table(f"{database}.product_raw").collect()} == expected
    import_products(spark, path, database, preflight_manifest=_manifest(
        tmp_path, {**read_manifest(spark, manifest), "duplicate_codes_path": None}),
        max_rows=6, dedupe="memory", truncate=True)
    firsts = list(dict.fromkeys(r[0] for r in rows[1:]))[:6]
    assert {r["code_norm"] for r in spark.table(f"{database}.product_raw").collect()} == set(firsts)


def test_export_in_several_files(spark, tmp_path, database):
    folder = tmp_path / "parts"
    folder.mkdir()
    write_rows(folder / "a.tsv", SCORED[:3])
    write_rows(folder / "b.tsv", [SCORED[0], *SCORED[3:]])
    manifest, row = preflight(spark, str(folder), tmp_path, duplicate_codes_out=str(tmp_path / "codes"))
    assert (row["code_total"], row["duplicate_occurrences"]) == (4, 2)
    assert row["file_bytes"] == sum(f.stat().st_size for f in folder.iterdir())
    totals = import_products(spark, str(folder), database, preflight_manifest=manifest).first()
    assert (totals["products"], totals["nutrients"]) == (2, 10)
    write_rows(folder / "b.tsv", SCORED)
    with pytest.raises(GateError, match="sha-256 mismatch"):
        import_products(spark, str(folder), database, preflight_manifest=manifest)


def test_bad_inputs(spark, tmp_path, database):
    path = write_rows(tmp_path / "nocode.tsv", [["kode", "x"], ["1", "2"]])
    with pytest.raises(InputError, match="no column code"):
        preflight(spark, path, tmp_path)
    (tmp_path / "empty.tsv").write_text("")
    with pytest.raises(InputError, match="empty"):
        preflight(spark, str(tmp_path / "empty.tsv"), tmp_path)
    (tmp_path / "bytes.tsv").write_bytes(b"code\tproduct_name\n1\tcaf\xe9\n")
    with pytest.raises(InputError, match="UTF-8"):
        preflight(spark, str(tmp_path / "bytes.tsv"), tmp_path)
    _, row = preflight(spark, str(tmp_path / "bytes.tsv"), tmp_path, encoding_errors="replace")
    assert row["code_total"] == 1


def test_blank_lines_are_records_without_code(spark, tmp_path):
    rows = ["\t".join(r) for r in TWO_PRODUCTS]
    path = tmp_path / "blank.tsv"
    path.write_text("\n".join([rows[0], "", rows[1], "", rows[2]]) + "\n")
    _, row = preflight(spark, str(path), tmp_path)
    assert (row["skipped_no_code"], row["code_total"]) == (2, 2)
