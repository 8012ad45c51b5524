"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default missing-value tokens of pandas' CSV reader (public pandas
# documentation of ``read_csv(na_values=...)``). A field equal to one of them is null.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Python's str.strip() removes every character for which str.isspace() is true: the
# Unicode White_Space set (incl. U+00A0, the no-break space of ISO-8859-1) plus the
# four information separators U+001C..U+001F. Java's (?U)\s is White_Space only.
_EDGE_BLANKS = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"


def strip_unicode(col: Column | str) -> Column:
    """Remove leading and trailing Unicode blanks, like Python's ``str.strip()``.

    ``F.trim`` only removes ASCII spaces, so a value wrapped in a no-break space or a tab
    would survive it. It is tried first, as the expression costs ten times as much: a text
    whose edges are then visible ASCII characters is stripped, any other is left to the
    expression.
    """
    c = F.col(col) if isinstance(col, str) else col
    t = F.trim(c)
    visible = F.substring(t, 1, 1).between("!", "~") & F.substring(t, -1, 1).between("!", "~")
    return F.when(visible, t).otherwise(F.regexp_replace(c, _EDGE_BLANKS, ""))


def na_to_null(col: Column | str, tokens: list[str] | None = None) -> Column:
    """Null out a string field equal to one of the missing-value tokens."""
    c = F.col(col) if isinstance(col, str) else col
    toks = PANDAS_NA_TOKENS if tokens is None else tokens
    if not toks:
        return c
    return F.when(c.isin(*toks), F.lit(None).cast("string")).otherwise(c)
