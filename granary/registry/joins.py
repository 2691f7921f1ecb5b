"""Label, extension, decode and match joins; lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from granary.operators.enrich import browse, extend, label, lookup, match_by_digits
from granary.registry.base import as_text, derive, query, select_sql, sql_digits, table
from granary.registry.duplicates import _BEST, product_load
from granary.session import scratch_path
from granary.sinks.layout import write_clustered, write_layout
from granary.sinks.tables import create_database, read_table, write_bucketed


@query("label_join", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_name AS part_name, p.p_type AS part_type
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
""")
def _label_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return label(lines, table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"},
                 {"p_name": "part_name", "p_type": "part_type"})


@query("extension_join", """
    SELECT o.o_orderkey, o.o_orderstatus, f.n AS "F_lines", p.n AS "P_lines"
    FROM (SELECT o_orderkey, o_orderstatus FROM orders) o
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) f
        ON f.l_orderkey = o.o_orderkey AND o.o_orderstatus = 'F'
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) p
        ON p.l_orderkey = o.o_orderkey AND o.o_orderstatus = 'P'
""")
def _extension_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    count = lambda where: lines.where(where).groupBy("o_orderkey").agg(F.count("*").alias("lines"))
    extensions = {"F": count("l_linestatus = 'F'"), "P": count("l_returnflag = 'N'")}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return extend(orders, extensions, "o_orderkey", "o_orderstatus")


@query("two_hop_join", """
    SELECT c.c_custkey, c.c_name, n.n_regionkey AS regionkey, r.r_name AS region
    FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def _two_hop_join(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    hop = label(customers, table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, {"n_regionkey": "regionkey"})
    return label(hop, table(spark, sf_dir, "region"), {"regionkey": "r_regionkey"}, {"r_name": "region"}).drop("c_nationkey")


@query("decode_join", """
    SELECT d.doc_id, d.lang, l.quality AS quality, l.toxic AS toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def _decode_join(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return label(documents, table(spark, sf_dir, "labels"), {"doc_id": "doc_id"},
                 {"quality": "quality", "toxic": "toxic"})


@query("bucketed_join", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey AS custkey, o.o_orderstatus AS status
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def _bucketed_join(spark, sf_dir):
    """A large table labelled from another large one, both bucketed by the join key."""
    db = f"bucketed_{uuid.uuid4().hex}"
    create_database(spark, db, scratch_path(spark, "bucketed"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_bucketed(lines, db, "lines", "l_orderkey", 16)
    write_bucketed(orders, db, "orders", "o_orderkey", 16)
    return label(read_table(spark, db, "lines"), read_table(spark, db, "orders"), {"l_orderkey": "o_orderkey"},
                 {"o_custkey": "custkey", "o_orderstatus": "status"})


_MEALS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_quantity": "l_quantity",
    "meal": "l_partkey",
    "part": f"CASE WHEN l_suppkey % 10 = 0 THEN 'n/a' ELSE {as_text('l_suppkey')} END",
}


@query("double_join", f"""
    SELECT i.l_orderkey, i.l_linenumber, i.l_quantity, i.meal, i.part, a.p_name AS composite, b.p_name AS ingredient
    FROM ({select_sql(_MEALS, "lineitem")}) i LEFT JOIN part a ON a.p_partkey = i.meal
    LEFT JOIN part b ON b.p_partkey = TRY_CAST(i.part AS BIGINT)
""")
def _double_join(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    composite = label(derive(table(spark, sf_dir, "lineitem"), _MEALS), part, {"meal": "p_partkey"}, {"p_name": "composite"})
    return label(composite, part, {"part": "p_partkey"}, {"p_name": "ingredient"})


_MIXED = {
    "o_orderkey": "o_orderkey",
    "category": f"CASE o_orderkey % 3 WHEN 0 THEN 'Oils Edible' ELSE {as_text('o_custkey')} END",
    "custkey": "o_custkey",
}
_DIMENSION = {"code": as_text("c_custkey"), "segment": "c_mktsegment", "number": "c_custkey"}


@query("mixed_key_join", f"""
    SELECT o.o_orderkey, o.category, o.custkey, a.segment AS by_text, b.segment AS by_number
    FROM ({select_sql(_MIXED, "orders")}) o
    LEFT JOIN ({select_sql(_DIMENSION, "customer")}) a ON a.number = TRY_CAST(o.category AS BIGINT)
    LEFT JOIN ({select_sql(_DIMENSION, "customer")}) b ON TRY_CAST(b.code AS BIGINT) = o.custkey
""")
def _mixed_key_join(spark, sf_dir):
    orders = derive(table(spark, sf_dir, "orders"), _MIXED)
    dimension = derive(table(spark, sf_dir, "customer"), _DIMENSION)
    by_text = label(orders, dimension, {"category": "number"}, {"segment": "by_text"})
    return label(by_text, dimension, {"custkey": "code"}, {"segment": "by_number"})


_BRANDED = {
    "o_orderkey": "o_orderkey",
    "gtin_upc": f"CASE o_orderkey % 4 WHEN 0 THEN 'none' ELSE '00 ' || {as_text('o_custkey')} || "
                f"'-' || {as_text('o_orderkey % 3')} END",
}


@query("barcode_match", f"""
    SELECT g.o_orderkey, g.gtin_upc, g.code_norm, b.product_name, b.brands AS product_brands
    FROM (SELECT *, {sql_digits('gtin_upc')} AS code_norm FROM ({select_sql(_BRANDED, "orders")}) o) g
    JOIN ({_BEST}) b ON b.code_norm = g.code_norm WHERE g.code_norm <> ''
""")
def _barcode_match(spark, sf_dir):
    branded = derive(table(spark, sf_dir, "orders"), _BRANDED)
    return match_by_digits(branded, "gtin_upc", product_load(spark, sf_dir), "code_norm",
                           {"product_name": "product_name", "brands": "product_brands"})


@query("lookup", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey = 77")
def _lookup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lookup(lines, "l_partkey", 77)


@query("lookup_layout", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey = 77")
def _lookup_layout(spark, sf_dir):
    """The same lookup over a copy of the table that is laid out for it."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    path = scratch_path(spark, "layout")
    write_layout(lines, "l_partkey", path, partitions=8)
    return lookup(spark.read.schema(lines.schema).parquet(path), "l_partkey", 77)


@query("lookup_clustered", """
    SELECT 'part' AS path, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey = 77
    UNION ALL SELECT 'order', l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey = 96
""")
def _lookup_clustered(spark, sf_dir):
    """Lookups by two columns over one copy that is clustered by both."""
    lines = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "clustered")
    write_clustered(lines, ["l_partkey", "l_orderkey"], path, partitions=16)
    copy = spark.read.schema(lines.schema).parquet(path)
    found = lambda name, column, value: lookup(copy, column, value).select(
        F.lit(name).alias("path"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return found("part", "l_partkey", 77).unionByName(found("order", "l_orderkey", 96))


@query("browse", "SELECT doc_id, lang, source FROM documents WHERE contains(text, 'the that')")
def _browse(spark, sf_dir):
    return browse(table(spark, sf_dir, "documents"), "text", "the that").select("doc_id", "lang", "source")
