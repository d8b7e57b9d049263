from tidewell.sinks.files import export_csv, write_batch, write_lake
from tidewell.sinks.layout import write_clustered
from tidewell.sinks.ledger import WriteLedger
from tidewell.sinks.maintenance import (
    compact, compact_table, file_detail, pack_files, partition_detail, table_detail,
)
from tidewell.sinks.upsert import (
    keyed_upsert, latest_per_key, touched_partitions, upsert_partitions, upsert_table,
)

__all__ = [
    "WriteLedger", "compact", "compact_table", "export_csv", "file_detail", "keyed_upsert",
    "latest_per_key", "pack_files", "partition_detail", "table_detail", "touched_partitions",
    "upsert_partitions", "upsert_table", "write_batch", "write_clustered", "write_lake",
]
