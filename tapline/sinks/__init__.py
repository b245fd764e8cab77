"""Sinks: JSON, NDJSON, CSV, TSV, Parquet, staged and versioned publish, and the manifest."""

from .formats import (
    COMPRESSIONS,
    FORMATS,
    delimited_lines,
    delimited_values,
    exact_decimal,
    json_array_lines,
    json_objects,
    json_values,
    ndjson_lines,
    normalize_format,
    parquet_values,
    write_delimited,
    write_json_array,
    write_parquet,
    write_text_lines,
)
from .parts import damaged_parts, part_frame, read_manifest, write_parts
from .publish import StagedOutput
from .versions import VersionedOutput, clean_versions, current_version, published_versions, read_current

__all__ = ["COMPRESSIONS", "FORMATS", "StagedOutput", "VersionedOutput", "clean_versions", "current_version", "damaged_parts", "delimited_lines", "delimited_values", "exact_decimal",
           "json_array_lines", "json_objects", "json_values", "ndjson_lines", "normalize_format",
           "parquet_values", "part_frame", "published_versions", "read_current",
           "read_manifest", "write_delimited", "write_json_array", "write_parquet", "write_parts", "write_text_lines"]
