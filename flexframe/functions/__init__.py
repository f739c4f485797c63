"""Column functions (all built from Spark expressions, no Python per row)."""

from .arrays import explode_with_index, explodeWithIndex, named_struct, namedStruct, replace_array_element, replaceArrayElement
from .rownumbers import with_row_numbers
from .urls import host_of, referer, search_url, url_extension, without_query

__all__ = [
    "explode_with_index", "explodeWithIndex", "named_struct", "namedStruct",
    "replace_array_element", "replaceArrayElement", "with_row_numbers",
    "host_of", "referer", "search_url", "url_extension", "without_query",
]
