"""The polled increment as a file stream."""

from paperloom.streaming.ingest import drop_redelivered, ingest_pages, stream_oai, stream_table, upsert_stream
from paperloom.streaming.latest import changed_versions, disk_state

__all__ = ["changed_versions", "disk_state", "drop_redelivered", "ingest_pages", "stream_oai", "stream_table", "upsert_stream"]
