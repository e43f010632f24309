"""Sources: JSON Lines, JSON arrays, mapping files."""

from staylake.sources.json_arrays import LAYOUTS, array_records, read_json_array, rewrite_json_arrays
from staylake.sources.json_lines import parse_json_lines, parse_records, read_json_lines, record_texts
from staylake.sources.mappings import load_mapping, mapping_from_dict, write_mapping

__all__ = [
    "LAYOUTS",
    "array_records",
    "load_mapping",
    "mapping_from_dict",
    "parse_json_lines",
    "parse_records",
    "read_json_array",
    "read_json_lines",
    "record_texts",
    "rewrite_json_arrays",
    "write_mapping",
]
