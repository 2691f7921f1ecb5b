import pytest
from granary.plans import import_products, preflight_products
from granary.sinks import publication as publishing
from granary.sinks.publication import create_published, publish, unpublished_loads
from granary.sources.tables import list_tables
from pyspark.sql import functions as F

from exports import TWO_PRODUCTS, write_rows


def counts(spark, database, *tables):
    return [spark.table(f"{database}.{t}").count() for t in tables]


def test_all_tables_of_a_load_or_none(spark, database):
    rows = spark.range(6).select("id", (F.col("id") % 3).alias("k"))
    create_published(spark, database, {"one": rows.schema, "two": rows.schema})
    assert counts(spark, database, "one", "two") == [0, 0]
    publish(spark, database, {"one": rows, "two": rows.where("k = 1")})
    bad = rows.withColumn("k", F.when(F.col("id") == 4, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="killed"):
        publish(spark, database, {"one": rows, "two": bad})
    assert counts(spark, database, "one", "two") == [6, 2]
    assert unpublished_loads(spark, database, "one").count() == 1
    publish(spark, database, {"one": rows.where("k = 0"), "two": rows})
    assert counts(spark, database, "one", "two") == [8, 8]
    publish(spark, database, {"one": rows.limit(1), "two": rows.limit(2)}, replace=True)
    assert counts(spark, database, "one", "two") == [1, 2]
    assert [r["table"] for r in list_tables(spark, database).collect()] == ["one", "two"]


def test_a_product_load_killed_between_its_tables(spark, database, tmp_path, monkeypatch):
    path = write_rows(tmp_path / "in.tsv", TWO_PRODUCTS)
    preflight_products(spark, path, str(tmp_path / "m"))
    monkeypatch.setattr(publishing, "write_table", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        import_products(spark, path, database, preflight_manifest=str(tmp_path / "m"))
    assert counts(spark, database, "product_raw", "nutrient_100g", "import_metadata") == [0, 0, 0]
    monkeypatch.undo()
    for _ in range(2):
        import_products(spark, path, database, preflight_manifest=str(tmp_path / "m"), truncate=True)
    assert counts(spark, database, "product_raw", "nutrient_100g", "import_metadata") == [2, 6, 2]
