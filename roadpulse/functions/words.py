"""Splitting text into lines and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_lines(text: Column) -> Column:
    """Lines of a text, ended by LF, CR LF or CR.  A final line end closes the
    last line and does not open an empty one.

    Literal replacements and a split on one character take less than half the
    time of a regular expression."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    closed = F.when(F.endswith(unix, F.lit("\n")), F.left(unix, F.length(unix) - 1)).otherwise(unix)
    return F.split(closed, "\n")


def split_words(line: Column) -> Column:
    """Split on single spaces.  Empty words at the end are dropped, empty words
    before or between others are kept, and an empty line is one empty word."""
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )
