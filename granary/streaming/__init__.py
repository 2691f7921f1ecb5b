from granary.streaming.incremental import (
    compact,
    current_rows,
    ingest_increment,
    read_stream,
    upsert_increment,
)

__all__ = ["compact", "current_rows", "ingest_increment", "read_stream", "upsert_increment"]
