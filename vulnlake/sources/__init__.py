"""Sources and sinks: JSON document trees, managed/path tables, CSV export."""

from .documents import Listing, discover_keys, list_files, scan_documents, split_documents, to_bronze_columns, with_ingest_metadata
from .tables import export_csv, preview, read_table, table_profile, write_table
from .upsert import latest_per_key, upsert_table

__all__ = ["Listing", "discover_keys", "export_csv", "latest_per_key", "list_files", "preview", "read_table", "scan_documents", "split_documents", "table_profile",
           "to_bronze_columns", "upsert_table", "with_ingest_metadata", "write_table"]
