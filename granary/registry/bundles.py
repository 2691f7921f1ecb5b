"""A whole bundle loaded by the job."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.plans.bundle import import_bundle
from granary.registry.base import fresh_database, query, table
from granary.registry.files import _write_csv
from granary.session import scratch_path
from granary.sinks.tables import read_table

#: By table of the bundle, the columns of its file and what they come from; ids are typed and checked.
_BUNDLE = {
    "customer": {"id": "c_custkey", "name": "c_name", "nation_id": "c_nationkey"},
    "documents": {"id": "doc_id", "name": "text", "nation_id": "n_chars"},
    "nation": {"id": "n_nationkey", "name": "n_name", "nation_id": "n_regionkey"},
    "orders": {"id": "o_orderkey", "name": "o_orderpriority", "nation_id": "o_custkey"},
    "part": {"id": "p_partkey", "name": "p_name", "nation_id": "p_size"},
    "supplier": {"id": "s_suppkey", "name": "s_name", "nation_id": "s_nationkey"},
}


@query("bundle_load", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, CAST(sum({c['id']}) AS BIGINT) AS ids,
               CAST(sum(length({c['name']})) AS BIGINT) AS chars, CAST(sum({c['nation_id']}) AS BIGINT) AS others
        FROM {name}""" for name, c in _BUNDLE.items()
))
def _bundle_load(spark, sf_dir):
    """Six tables, each a folder of CSV files, three of them at a time; sums over what was loaded."""
    folder, database = scratch_path(spark, "bundle"), fresh_database(spark, "bundle_load")
    for name, columns in _BUNDLE.items():
        _write_csv(table(spark, sf_dir, name).select(*[F.col(c).alias(n) for n, c in columns.items()]), f"{folder}/{name}.csv")
    counts = import_bundle(spark, folder, database, at_once=3)
    loaded = [
        read_table(spark, database, name).agg(
            F.sum("id").alias("ids"), F.sum(F.length("name")).alias("chars"), F.sum("nation_id").alias("others")
        ).select(F.lit(name).alias("table"), "ids", "chars", "others")
        for name in _BUNDLE
    ]
    sums = loaded[0]
    for more in loaded[1:]:
        sums = sums.unionByName(more)
    return counts.join(sums, "table").select("table", "rows", "ids", "chars", "others")
