"""Reading and writing files: delimited text, manifests, code lists, fingerprints."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import catalog
from granary.functions import digits_key
from granary.operators.conform import record_width
from granary.operators.dedupe import duplicate_keys, profile_duplicates
from granary.plans.preflight import manifest_row
from granary.plans.products import rows_read
from granary.registry.base import (
    as_text,
    derive,
    product_export,
    query,
    table,
)
from granary.registry.duplicates import _EXPORT_CODES, _LINE_CODES, _LINE_COUNTS, _PROFILE
from granary.session import scratch_path, stage
from granary.sinks.files import write_code_list, write_manifest
from granary.sources.bundle import bundle_inventory, read_expected_counts
from granary.sources.delimited import CORRUPT, SOURCE_ORDER, profile_lines, read_delimited, record_numbers
from granary.sources.files import list_files
from granary.sources.fingerprint import fingerprint
from granary.sources.manifest import manifest_fields, read_code_list

_DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _write_csv(df, path, sep=",", compression="none", quote_all=True):
    (
        df.write.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
        .option("quoteAll", quote_all).option("emptyValue", "").option("compression", compression)
        .csv(path)
    )


@query("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _csv_round_trip(spark, sf_dir):
    """Whole documents through quoted gzip CSV and the strict scan."""
    path = scratch_path(spark, "documents-csv")
    _write_csv(table(spark, sf_dir, "documents").select(*_DOCUMENT), path, compression="gzip")
    read = read_delimited(spark, path, sep=",", strict=True)
    return read.where(F.col(CORRUPT).isNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )


@query("csv_multiline", """
    SELECT item_id AS id, 'benchmark' AS kind, text FROM benchmark
    UNION ALL SELECT page_id, 'pages', html FROM pages
""")
def _csv_multiline(spark, sf_dir):
    """Quoted line breaks in plain files, found by the line profile."""
    rows = (
        table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.lit("benchmark").alias("kind"), "text")
        .unionByName(table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("id"), F.lit("pages").alias("kind"), F.col("html").alias("text")))
    )
    path = scratch_path(spark, "multiline-csv")
    _write_csv(rows, path)
    return read_delimited(spark, path, sep=",", strict=True).select(F.col("id").cast("bigint").alias("id"), "kind", "text")


@query("mixed_files", """
    SELECT c_custkey AS key, CASE WHEN c_custkey % 50 = 7 THEN 'two' || chr(10) || 'lines ' || c_name ELSE c_name END AS name
    FROM customer
""")
def _mixed_files(spark, sf_dir):
    """Ordered files of which some hold quoted line breaks; only those are read whole."""
    name = F.when(F.expr("c_custkey % 50 = 7"), F.concat(F.lit("two\nlines "), "c_name")).otherwise(F.col("c_name"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), name.alias("name"))
    path = scratch_path(spark, "mixed")
    _write_csv(customers.repartitionByRange(40, "key"), path, quote_all=False)
    return read_delimited(spark, path, sep=",", strict=True).select(F.col("key").cast("bigint").alias("key"), "name")


def _line_files(df, key, line, header, compression="none", rows=10_000):
    """Text files of lines in the order of a dense whole-number key, each with a header line; ``rows`` keys a file.

    The lines of a file are one value, as no writer of lines keeps blank ones below a header.
    """
    path = scratch_path(df.sparkSession, "lines")
    piece = F.format_string("%012d", F.expr(f"{key} DIV {rows}"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), line.alias("line"))))
    files = df.groupBy(piece.alias("piece")).agg(F.concat(F.lit(f"{header}\n"), F.array_join(ordered["line"], "\n")).alias("value"))
    files.write.partitionBy("piece").option("compression", compression).text(path)
    return f"{path}/*"


@query("blank_lines", """
    SELECT coalesce(CAST(CASE c_custkey % 3 WHEN 0 THEN '' ELSE c_name END AS VARCHAR), '') AS name, count(*) AS rows
    FROM customer GROUP BY 1
""")
def _blank_lines(spark, sf_dir):
    """Every third line of a lenient export is blank and counts as a record without cells."""
    line = F.when(F.expr("c_custkey % 3 = 0"), "").otherwise(F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name"))
    path = _line_files(table(spark, sf_dir, "customer"), "c_custkey", line, "key\tname")
    return read_delimited(spark, path, columns=["name"]).groupBy("name").agg(F.count("*").alias("rows"))


_ODD_LINE = """
    CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN concat(event_id, ',"', event_type, '\n\n', props_, '"')
    WHEN 2 THEN concat(event_id, ',"', event_type, '" and more') ELSE concat(event_id, ',', event_type) END
"""
_ODD_SQL = """
    SELECT CASE event_id % 7 WHEN 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS id,
           CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN event_type || chr(10) || chr(10) || replace(props, '"', '')
           WHEN 2 THEN event_type || ' and more' ELSE event_type END AS kind,
           row_number() OVER (ORDER BY event_id) + 1 AS record_number FROM events
"""


def _odd_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("props_", F.translate("props", '"', ""))


def _numbered(read):
    scan = stage(read, "numbered")
    return record_numbers(scan).select(*[c for c in scan.columns if not c.startswith("_src_")], F.col("record_number").cast("bigint").alias("record_number"))


@query("scan_parity", _ODD_SQL)
def _scan_parity(spark, sf_dir):
    """Quoted breaks, blank records and text behind a closing quote, with dense record numbers."""
    path = _line_files(_odd_events(spark, sf_dir), "event_id", F.expr(_ODD_LINE), "id,kind", rows=200_000)
    return _numbered(read_delimited(spark, path, sep=",", with_order=True))


@query("blank_gzip", _ODD_SQL)
def _blank_gzip(spark, sf_dir):
    """The same from gzip files, each unpacked once."""
    path = _line_files(_odd_events(spark, sf_dir), "event_id", F.expr(_ODD_LINE), "id,kind", compression="gzip")
    return _numbered(read_delimited(spark, path, sep=",", with_order=True))


@query("bom_scan", "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer")
def _bom_scan(spark, sf_dir):
    """A byte-order mark before the header is no part of the first column's name."""
    line = F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name")
    path = _line_files(table(spark, sf_dir, "customer"), "c_custkey", line, "\ufeffcode\tname")
    return read_delimited(spark, path, columns=["code", "name"])


@query("cell_limit", "SELECT length(text) AS chars, count(*) AS cells FROM documents GROUP BY 1")
def _cell_limit(spark, sf_dir):
    """Every text fits into a limit of the longest one; with one character less the scan is refused."""
    path = scratch_path(spark, "cells")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    _write_csv(texts, path)
    longest = texts.agg(F.max(F.length("text"))).first()[0]
    cells = stage(read_delimited(spark, path, sep=",", strict=True, max_chars=longest).select("text"), "cells")
    try:
        read_delimited(spark, path, sep=",", strict=True, max_chars=longest - 1).write.format("noop").mode("overwrite").save()
    except PySparkException:
        return cells.groupBy(F.length("text").alias("chars")).agg(F.count("*").alias("cells"))
    raise AssertionError("a cell beyond the limit was read")


_WITH_BLANKS = "CASE WHEN event_id % 5 = 3 THEN '' ELSE concat('0', event_id, '\t', event_type) END"


@query("blank_numbers", """
    SELECT CASE event_id % 5 WHEN 3 THEN '' ELSE '0' || CAST(event_id AS VARCHAR) END AS code,
           CASE event_id % 5 WHEN 3 THEN '' ELSE event_type END AS kind,
           row_number() OVER (ORDER BY event_id) + 1 AS record_number FROM events
""")
def _blank_numbers(spark, sf_dir):
    """Blank lines of plain files are numbered where they stand."""
    path = _line_files(table(spark, sf_dir, "events"), "event_id", F.expr(_WITH_BLANKS), "code\tkind")
    return _numbered(read_delimited(spark, path, with_order=True))


@query("blank_capped", """
    WITH c AS (SELECT event_id, event_id % 5 = 3 AS blank, count(*) FILTER (event_id % 5 <> 3) OVER (ORDER BY event_id) AS n FROM events)
    SELECT count(*) AS rows_read, count(*) FILTER (blank) AS skipped_no_code, max(CASE WHEN NOT blank THEN event_id END) AS last
    FROM c WHERE event_id <= (SELECT min(event_id) FROM c WHERE n = 777 AND NOT blank)
""")
def _blank_capped(spark, sf_dir):
    """Blank lines behind the last row that a cap admits are not read."""
    path = _line_files(table(spark, sf_dir, "events"), "event_id", F.expr(_WITH_BLANKS), "code\tkind", rows=500)
    scan = stage(read_delimited(spark, path, columns=["code"], with_order=True), "capped")
    rows = scan.withColumn("code_norm", digits_key(F.col("code")))
    read = rows_read(rows, SOURCE_ORDER, "none", max_rows=777)
    return read.agg(
        F.count("*").alias("rows_read"), F.count_if(F.col("code_norm") == "").alias("skipped_no_code"),
        F.max(F.when(F.col("code_norm") != "", F.col("code_norm").cast("bigint"))).alias("last"),
    )


@query("null_bytes", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN 3 ELSE 2 END AS chars FROM events
""")
def _null_bytes(spark, sf_dir):
    """NUL characters in quoted and bare cells reach the strict scan."""
    cell = F.expr("CASE event_id % 3 WHEN 0 THEN '\"a\\0b\"' WHEN 1 THEN 'a\\0' ELSE 'ab' END")
    path = scratch_path(spark, "nul")
    lines = table(spark, sf_dir, "events").select(F.concat_ws(",", F.col("event_id").cast("string"), cell).alias("line"))
    _with_header(lines, "event_id,cell", path)
    return read_delimited(spark, path, sep=",", strict=True).select(
        F.col("event_id").cast("bigint").alias("event_id"), F.length("cell").alias("chars"))


# ragged lines: short and long records, and a repeated header
_RAGGED = {
    "line": f"{as_text('c_custkey')} || chr(9) || c_name || CASE c_custkey % 4 WHEN 0 THEN '' "
            "WHEN 1 THEN chr(9) || c_mktsegment WHEN 2 THEN chr(9) || c_mktsegment || chr(9) || 'last' "
            "ELSE chr(9) || c_mktsegment || chr(9) || 'last' || chr(9) || 'extra' END",
}


def _with_header(df, header, path):
    """Text files whose first line is ``header``."""
    lines = df.select(F.lit(header).alias("first"), "line")
    lines.select(F.col("line").alias(header)).write.option("header", True).option("sep", "\x01").option(
        "quote", "").option("escapeQuotes", False).option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@query("lenient_scan", """
    SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 4 IN (2, 3) THEN 'last' ELSE '' END AS name,
           CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment, '' AS absent FROM customer
""")
def _lenient_scan(spark, sf_dir):
    path = scratch_path(spark, "ragged")
    _with_header(derive(table(spark, sf_dir, "customer"), _RAGGED), "key\tname\tsegment\tname", path)
    return read_delimited(spark, path, columns=["key", "name", "segment", "absent"])


@query("strict_scan", """
    SELECT kind, count(*) AS rows, CAST(sum(cells) AS BIGINT) AS cells FROM (
        SELECT CASE WHEN c_custkey % 4 = 2 THEN 'ok' ELSE 'wrong width' END AS kind,
               CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 5 END AS cells FROM customer) c
    GROUP BY kind
""")
def _strict_scan(spark, sf_dir):
    """Records of the wrong width are told apart, with how many cells they have."""
    ragged = derive(table(spark, sf_dir, "customer"), _RAGGED)
    path = scratch_path(spark, "ragged-csv")
    _with_header(ragged.select(F.translate("line", "\t", ",").alias("line")), "key,name,segment,note", path)
    read = read_delimited(spark, path, sep=",", strict=True)
    kind = F.when(F.col(CORRUPT).isNull(), "ok").otherwise("wrong width")
    width = F.when(F.col(CORRUPT).isNull(), 4).otherwise(record_width(F.col(CORRUPT)))
    return read.groupBy(kind.alias("kind")).agg(
        F.count("key").alias("rows"), F.sum(width).cast("bigint").alias("cells"))


@query("encoding_gate", """
    SELECT count(*) AS lines, count(*) FILTER (event_id % 10 = 3) AS invalid_lines,
           count(*) FILTER (event_id % 10 = 4) AS blank_lines, count(*) FILTER (event_id % 10 = 5) AS open_lines
    FROM events
""")
def _encoding_gate(spark, sf_dir):
    """Line profile of files with broken bytes, blank lines and unclosed quotes."""
    cell = F.expr("""
        CASE event_id % 10 WHEN 3 THEN CAST(concat(encode(props, 'utf-8'), X'FF') AS STRING) WHEN 4 THEN ''
        WHEN 5 THEN '"open' ELSE event_type || chr(9) || '"a ""quoted"" cell"' END
    """)
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(cell.alias("value")).write.text(path)
    return profile_lines(spark, path, "\t", "code\tname").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("lines", "invalid_lines", "blank_lines", "open_lines")])


@query("record_numbers", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, row_number() OVER (ORDER BY event_id) + 1 AS record_number FROM events
""")
def _record_numbers(spark, sf_dir):
    """Dense record numbers over many files written in order."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    path = scratch_path(spark, "ordered")
    _write_csv(events.repartitionByRange(5, "event_id").sortWithinPartitions("event_id"), path, sep="\t")
    scan = stage(read_delimited(spark, path, with_order=True), "ordered")
    return record_numbers(scan).select("event_id", F.col("record_number").cast("bigint").alias("record_number"))


_MANIFEST_SQL = f"""
    WITH p AS ({_PROFILE.format(counts=f"SELECT code, count(*) AS n FROM ({_EXPORT_CODES}) x GROUP BY code")})
    SELECT *, 1::BIGINT AS format_version, 'tab' AS delimiter, NULL::VARCHAR AS duplicate_codes_path,
           0::BIGINT AS duplicate_codes_count,
           (SELECT string_agg(code, ',' ORDER BY code) FROM (
               SELECT code FROM ({_EXPORT_CODES}) x WHERE code <> '' GROUP BY code HAVING count(*) > 1
               ORDER BY code LIMIT 20) d) AS duplicate_samples
    FROM p
"""


@query("manifest_round_trip", _MANIFEST_SQL)
def _manifest_round_trip(spark, sf_dir):
    """The manifest of the export's codes, written and read back under its schema."""
    codes = product_export(spark, sf_dir).select(digits_key(F.col("code")).alias("code_norm"))
    literals = {
        "format_version": F.lit(1).cast("bigint"), "delimiter": F.lit("tab"),
        "duplicate_codes_path": F.lit(None).cast("string"),
    }
    manifest = manifest_row(
        profile_duplicates(codes, "code_norm"), duplicate_keys(codes, "code_norm"), 20, literals)
    path = scratch_path(spark, "manifest")
    write_manifest(manifest, path)
    schema = T.StructType([f for f in catalog.MANIFEST_SCHEMA if f.name in manifest.columns])
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return read.withColumn("duplicate_samples", F.array_join("duplicate_samples", ","))


@query("manifest_fields", """
    SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN NULL ELSE octet_length(encode(text)) END AS file_bytes,
           CASE doc_id % 6 WHEN 0 THEN NULL WHEN 2 THEN NULL ELSE doc_id % 2 = 1 END AS duplicates_found,
           CASE WHEN doc_id % 6 = 0 THEN NULL ELSE sha256(text) END AS file_sha256,
           CASE doc_id % 6 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'file_bytes is not a bigint'
           WHEN 2 THEN 'duplicates_found is not a boolean' END AS problem FROM documents
""")
def _manifest_fields(spark, sf_dir):
    """One manifest per document, with typical faults: no object, a size that is no number, a flag that is no truth value."""
    documents = table(spark, sf_dir, "documents")
    fault = F.col("doc_id") % 6
    text = F.to_json(F.struct(
        F.sha2("text", 256).alias("file_sha256"),
        F.when(fault == 1, "not_an_int").otherwise(F.octet_length("text").cast("string")).alias("file_bytes"),
        F.when(fault == 2, "not_a_bool").when(fault == 3, "true").otherwise((F.col("doc_id") % 2 == 1).cast("string")).alias("duplicates_found"),
        F.lit("tab").alias("delimiter"), F.col("doc_id").cast("string").alias("file_path"),
    ))
    written = documents.select("doc_id", F.when(fault == 0, F.concat(F.lit("["), F.to_json(F.array(F.lit("not"))), F.lit("]"))).otherwise(text).alias("value"))
    read = manifest_fields(written, keep=["doc_id"])
    return read.select("doc_id", "file_bytes", "duplicates_found", "file_sha256", "problem")


@query("code_list", f"SELECT DISTINCT code FROM ({_LINE_COUNTS}) c WHERE code <> '' AND n > 1")
def _code_list(spark, sf_dir):
    """Duplicate codes written one per line, appended again with blanks, read as a set."""
    codes = duplicate_keys(derive(table(spark, sf_dir, "lineitem"), _LINE_CODES), "code")
    path = scratch_path(spark, "codes")
    write_code_list(codes, path)
    padded = F.concat(F.lit("  "), F.col("code"), F.lit("\t"))
    codes.select(padded.alias("value")).unionByName(codes.select(F.lit(" ").alias("value"))).write.mode("append").text(path)
    return read_code_list(spark, path)


@query("expected_counts", """
    SELECT lower(replace(source, '-', '_')) || '_part' AS "table", count(*) AS expected_rows FROM documents GROUP BY source
""")
def _expected_counts(spark, sf_dir):
    """A record-count file derived from the document sources."""
    name = F.col("Table")
    counts = table(spark, sf_dir, "documents").groupBy(
        F.concat(F.col("source"), F.lit(" Part.csv")).alias("Table")
    ).agg(F.count("*").alias("Number of Records"))
    own = spark.createDataFrame([("all_downloaded_table_record_counts.csv", 7), ("Total", 9)], counts.schema)
    path = scratch_path(spark, "counts")
    _write_csv(counts.unionByName(own).select(name, "Number of Records"), path)
    return read_expected_counts(spark, path)


@query("bundle_inventory")
def _bundle_inventory(spark, sf_dir):
    """Files of a bundle written from the document sources, with sizes and expected rows."""
    documents = table(spark, sf_dir, "documents")
    counts = documents.groupBy(F.col("source").alias("table")).agg(F.count("*").alias("expected_rows"))
    path = scratch_path(spark, "bundle")
    documents.withColumn("part", F.col("source")).write.partitionBy("part").option("header", True).csv(path)
    files = list_files(spark, f"{path}/*/*.csv").select(
        F.concat(F.regexp_extract("path", "part=([^/]*)/", 1), F.lit(".csv")).alias("path"), "length"
    ).groupBy("path").agg(F.sum("length").alias("length"))
    return bundle_inventory(files, counts, only=["web"])


@query("fingerprint")
def _fingerprint(spark, sf_dir):
    """SHA-256 and size of every given file."""
    return fingerprint(spark, sf_dir, glob="*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "file_sha256", "file_bytes"
    )


@query("content_fingerprint", "SELECT page_id, sha256(html) AS file_sha256 FROM pages")
def _content_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("file_sha256"))


_NAMES_SQL = """
    SELECT c_nationkey AS nation, sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS file_sha256,
           CAST(sum(octet_length(encode(c_name)) + 1) AS BIGINT) AS file_bytes FROM customer GROUP BY c_nationkey
"""


def _name_files(spark, sf_dir):
    """One text file per nation, the names of its customers in order."""
    path = scratch_path(spark, "names")
    names = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("value"))
    ordered = names.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.drop("c_custkey").write.partitionBy("c_nationkey").text(path)
    return path


@query("fingerprint_files", _NAMES_SQL)
def _fingerprint_files(spark, sf_dir):
    """SHA-256 and size of files whose contents are known."""
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1).cast("int").alias("nation")
    return fingerprint(spark, f"{_name_files(spark, sf_dir)}/*").select(nation, "file_sha256", "file_bytes")


@query("bundle_files", f"""
    SELECT 'n' || CAST(n.nation AS VARCHAR) AS "table", n.file_bytes AS bytes,
           CASE WHEN n.nation % 3 = 0 THEN 0 ELSE k.rows END AS expected_rows, n.nation = 7 AS selected
    FROM ({_NAMES_SQL}) n JOIN (SELECT c_nationkey, count(*) AS rows FROM customer GROUP BY 1) k ON k.c_nationkey = n.nation
""")
def _bundle_files(spark, sf_dir):
    """Inventory of a bundle of known files; a third of them lack an expected count."""
    files = list_files(spark, f"{_name_files(spark, sf_dir)}/*").select(
        F.concat(F.lit("n"), F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1), F.lit(".csv")).alias("path"), "length")
    counts = table(spark, sf_dir, "customer").where("c_nationkey % 3 <> 0").groupBy(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("table")).agg(F.count("*").alias("expected_rows"))
    return bundle_inventory(files, counts, only=["N7"])
