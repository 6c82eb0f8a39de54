from .manifest import buckets_of, frequent_keys, frequent_keys_of
from .readers import file_position, read_dictionary, read_observed, read_raw, read_raw_observed, read_table
from .schemas import RAW_SCHEMAS
from .sinks import Stages, hadoop_path, shared_folder, stored_bytes, write_stage

__all__ = [
    "RAW_SCHEMAS",
    "buckets_of",
    "file_position",
    "frequent_keys",
    "frequent_keys_of",
    "Stages",
    "hadoop_path",
    "stored_bytes",
    "read_dictionary",
    "read_observed",
    "read_raw",
    "read_raw_observed",
    "read_table",
    "shared_folder",
    "write_stage",
]
