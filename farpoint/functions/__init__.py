"""Column expressions shared by the operators."""

from farpoint.functions.keys import hash_part, id_part
from farpoint.functions.text import document_lines_expr, java_space_split, utf16_length
from farpoint.functions.vectors import (
    dist_to_const,
    euclidean,
    parse_vector,
    sqdist,
    sqdist_to_const,
    to_double_vector,
)

__all__ = [
    "document_lines_expr", "java_space_split", "utf16_length",
    "sqdist", "euclidean", "sqdist_to_const", "dist_to_const", "parse_vector",
    "to_double_vector", "id_part", "hash_part",
]
