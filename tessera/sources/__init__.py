"""Sources (text lines, delimited tables, ratings) and sinks."""

from .text import (first_rows, label_features, parse_numeric, read_lines, read_ratings,
                   read_table)
from .sinks import preview, write_vectors

__all__ = ["read_lines", "first_rows", "read_table", "parse_numeric", "read_ratings",
           "label_features", "write_vectors", "preview"]
