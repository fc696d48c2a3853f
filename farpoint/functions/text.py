"""Text expressions: line splitting and the single-space tokeniser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_space_split(col: Column | str) -> Column:
    """Tokens of ``col`` split on single spaces, with Java ``split(" ")`` rules.

    Leading and inner empty tokens are kept, trailing empty tokens dropped;
    ``""`` gives ``[""]`` and an all-space string gives ``[]``.  Spark's own
    ``split`` keeps trailing empties, so the trailing spaces are trimmed
    first (``rtrim`` removes only U+0020, like the separator).
    """
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.rtrim(c)
    return (F.when((F.length(c) > 0) & (trimmed == F.lit("")),
                   F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def document_lines_expr(col: Column | str) -> Column:
    """Lines of a text value: they end at ``\\n``, ``\\r\\n`` or ``\\r``, like a text file's.

    A document of the reference is one line of a text file; a text value
    with embedded newlines is therefore a small file of lines.  A final
    line end ends the last line instead of opening an empty one.
    """
    c = F.col(col) if isinstance(col, str) else col
    body = F.regexp_replace(c, r"(\r\n|\n|\r)\z", "")
    return F.split(body, r"\r\n|\n|\r", -1)


def utf16_length(col: Column | str) -> Column:
    """Length in UTF-16 code units (Java ``String.length``).

    ``length`` counts code points; characters above U+FFFF take two units.
    """
    c = F.col(col) if isinstance(col, str) else col
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("bigint")
