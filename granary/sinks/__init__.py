from granary.sinks.events import event_rows, log_events
from granary.sinks.files import write_code_list, write_manifest
from granary.sinks.layout import select_access_paths, write_layout
from granary.sinks.publication import create_published, publish, unpublished_loads
from granary.sinks.tables import (
    append_provenance,
    create_database,
    drop_database,
    read_table,
    snapshot_schema,
    table_ddl,
    truncate_table,
    write_bucketed,
    write_table,
)

__all__ = [
    "append_provenance", "create_database", "create_published", "publish", "unpublished_loads", "drop_database", "event_rows", "log_events",
    "read_table", "select_access_paths", "snapshot_schema", "table_ddl", "truncate_table",
    "write_bucketed", "write_code_list", "write_layout", "write_manifest", "write_table",
]
