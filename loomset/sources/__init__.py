"""Sources and sinks."""

from loomset.sources.files import (
    RoutedPaths,
    SplitRoutes,
    discover_corpus,
    route_table,
    scan_json,
    scan_json_texts,
    scan_jsonl,
)
from loomset.sources.sinks import (
    exists,
    read_note,
    remove,
    scratch,
    shared_dir,
    stage,
    write_jsonl,
    write_jsonl_pair,
    write_note,
    write_split_table,
)

__all__ = [
    "RoutedPaths",
    "SplitRoutes",
    "discover_corpus",
    "exists",
    "read_note",
    "remove",
    "route_table",
    "scan_json",
    "scan_json_texts",
    "scan_jsonl",
    "scratch",
    "shared_dir",
    "stage",
    "write_jsonl",
    "write_jsonl_pair",
    "write_note",
    "write_split_table",
]
