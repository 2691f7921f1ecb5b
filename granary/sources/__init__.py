from granary.sources.bundle import (
    bundle_inventory,
    load_bundle,
    read_expected_counts,
    select_tables,
)
from granary.sources.delimited import (
    detect_delimiter,
    profile_lines,
    read_delimited,
    read_header,
    record_numbers,
)
from granary.sources.files import list_files
from granary.sources.fingerprint import combined_fingerprint, fingerprint
from granary.sources.manifest import read_code_list, read_manifest
from granary.sources.tables import list_tables

__all__ = [
    "bundle_inventory", "combined_fingerprint", "detect_delimiter", "fingerprint", "list_files", "list_tables",
    "load_bundle", "profile_lines", "read_code_list", "read_delimited", "read_expected_counts",
    "read_header", "read_manifest", "record_numbers", "select_tables",
]
