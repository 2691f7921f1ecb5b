"""Command line of the jobs, for ``spark-submit`` or ``python -m granary``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from granary import plans
from granary.session import SETTINGS
from granary.sinks.layout import select_access_paths
from granary.sources.delimited import MAX_CELL_CHARS, TAB


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="granary")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, logs: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        if logs:
            sub.add_argument("--log-file", dest="log_path")
            sub.add_argument("--log-format", choices=["text", "jsonl"], default="text")
        return sub

    def selection(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--only", action="append", default=[])
        sub.add_argument("--skip", action="append", default=[])

    def export(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--tsv-path", dest="path", required=True)
        sub.add_argument("--delimiter", default=TAB)
        sub.add_argument("--field-size-limit", dest="max_chars", type=int, default=MAX_CELL_CHARS)
        sub.add_argument("--encoding-errors", choices=["strict", "replace"], default="strict")

    bundle = job("import-bundle")
    bundle.add_argument("--csv-dir", required=True)
    bundle.add_argument("--schema", dest="database", default="usda")
    bundle.add_argument("--location")
    selection(bundle)
    for flag in ("drop-schema", "truncate", "resume", "benchmark"):
        bundle.add_argument(f"--{flag}", action="store_true", dest=flag.removesuffix("-schema"))
    bundle.add_argument("--at-once", type=int, default=1, help="tables that load side by side")
    bundle.add_argument("--dictionary", help="text file with the data dictionary")

    preflight = job("preflight")
    export(preflight)
    preflight.add_argument("--manifest-out", required=True)
    preflight.add_argument("--duplicate-codes-out")
    preflight.add_argument("--duplicate-samples", type=int, default=20)

    products = job("import-products")
    export(products)
    products.add_argument("--schema", dest="database", default="openfoodfacts")
    products.add_argument("--location")
    products.add_argument("--truncate", action="store_true")
    products.add_argument("--nutrients", choices=["minimal", "all"], default="minimal")
    products.add_argument("--include-salt", action="store_true")
    products.add_argument("--max-rows", type=int, default=0)
    products.add_argument("--expected-sha256")
    products.add_argument("--preflight-manifest")
    products.add_argument("--duplicate-codes")
    products.add_argument("--dedupe", choices=["none", "memory", "best"], default="none")

    layout = job("layout")
    layout.add_argument("--schema", dest="database", default="usda")
    layout.add_argument("--location")
    layout.add_argument("--list", action="store_true")
    selection(layout)

    verify = job("verify")
    verify.add_argument("--schema", dest="database", required=True)

    snapshot = job("snapshot", logs=False)
    snapshot.add_argument("--schema", dest="database", required=True)
    snapshot.add_argument("--output", required=True)
    return parser


def main(argv: list[str] | None = None) -> int:
    options = vars(_parser().parse_args(argv))
    name = options.pop("job")
    if name == "layout" and options.pop("list"):
        print("\n".join(p.name for p in select_access_paths(options["only"], options["skip"])))
        return 0
    spark = SparkSession.builder.appName(f"granary {name}").config(map=SETTINGS).getOrCreate()
    if name == "import-bundle":
        if options["dictionary"]:
            page = spark.read.option("wholetext", True).text(options["dictionary"]).first()
            options["dictionary"] = page["value"] if page else None
        plans.import_bundle(spark, **options).show(100, truncate=False)
    elif name == "preflight":
        plans.preflight_products(spark, **options).show(truncate=False)
    elif name == "import-products":
        plans.import_products(spark, **options).show(truncate=False)
    elif name == "verify":
        plans.verify_database(spark, **options).show(1000, truncate=False)
    elif name == "layout":
        if not options["location"]:
            raise SystemExit("--location is required")
        print("\n".join(plans.layout_tables(spark, **options).values()))
    else:
        plans.snapshot_text(spark, **options)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
