"""Sources and sinks: raw tables, seeds, landing copies, key allocation, writes."""

from sparkmarts.sources.readers import SOURCE_TABLES, read_source, source_path, table_exists
from sparkmarts.sources.seeds import SEED_NAMES, load_seed
from sparkmarts.sources.sinks import save_table, store_failures

__all__ = [
    "SEED_NAMES",
    "SOURCE_TABLES",
    "load_seed",
    "read_source",
    "save_table",
    "source_path",
    "store_failures",
    "table_exists",
]
