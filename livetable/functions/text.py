"""Text functions: line and word splitting, blank tests, substring filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space for "is not blank"
# (the JVM's Character.isWhitespace set), written as one regex class that both
# Spark and DuckDB accept:
#   \t \n \x0B \f \r, \x1C-\x1F, space, U+1680, U+2000-U+2006, U+2008-U+200A,
#   U+2028, U+2029, U+205F, U+3000
WHITESPACE_CLASS = (r"\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}"
                    r"\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}")
NON_BLANK_PATTERN = "[^" + WHITESPACE_CLASS + "]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words_array(line) -> Column:
    """Words of a line split on single blanks, with the JVM ``split(" ")`` rule:
    inner empty words are kept, trailing empty words are removed, an empty line
    gives one empty word and an all-blank line gives none."""
    v = _c(line)
    trimmed = F.rtrim(v)  # Spark's rtrim removes trailing blanks (0x20) only
    return (F.when(v == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def split_words(df: DataFrame, col: str = "value", name: str = "word",
                keep: list[str] | None = None) -> DataFrame:
    """One row per word (``flatMap(_.split(" "))``)."""
    return df.select(*(keep or []), F.explode(words_array(col)).alias(name))


def lines_of(df: DataFrame, col: str = "text", name: str = "value",
             keep: list[str] | None = None, with_number: bool = False) -> DataFrame:
    """One row per ``\\n``-separated line of a text column; empty lines kept."""
    parts = F.split(F.col(col), "\n", -1)
    if with_number:
        return df.select(*(keep or []), F.posexplode(parts).alias("line_no", name))
    return df.select(*(keep or []), F.explode(parts).alias(name))


def is_not_blank(c) -> Column:
    """Not null and holding at least one non-white-space character."""
    v = _c(c)
    return v.isNotNull() & v.rlike(NON_BLANK_PATTERN)


def nonblank(df: DataFrame, col: str = "value") -> DataFrame:
    return df.filter(is_not_blank(col))


def contains_text(df: DataFrame, needle: str, col: str = "value") -> DataFrame:
    """Substring filter on the whole line."""
    return df.filter(_c(col).contains(needle))
