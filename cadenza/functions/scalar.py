"""Scalar column functions (X1-X13) used by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the token separator of the reference's word counts.
WORD_SPLIT = r"\s+"


def tokens(col: str | Column) -> Column:
    """Split on runs of white space. Leading/trailing blanks give '' tokens."""
    return F.split(F.col(col) if isinstance(col, str) else col, WORD_SPLIT)


def text_length(col: str) -> Column:
    """Characters in a string."""
    return F.length(col)


def uri_to_id(col: str, sep: str = ":") -> Column:
    """The part after the last separator."""
    return F.substring_index(F.col(col), sep, -1)


def epoch_to_date(col: str) -> Column:
    """Epoch seconds -> date in the session time zone (set UTC, T17)."""
    return F.to_date(F.from_unixtime(F.col(col)))


def safe_ln(col: str | Column) -> Column:
    """Natural log, NULL unless positive (T9: Spark NULL vs -inf elsewhere)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > 0, F.ln(c))


def log1p(col: str | Column) -> Column:
    """ln(1 + x)."""
    return F.log1p(F.col(col) if isinstance(col, str) else col)


def ms_to_minutes(col: str | Column) -> Column:
    """X11: milliseconds -> minutes."""
    c = F.col(col) if isinstance(col, str) else col
    return c / F.lit(60000.0)


def to_double(col: str) -> Column:
    """Numeric harmonisation; bad input gives NULL (T18: ANSI casts raise)."""
    return F.col(col).try_cast("double")


def columns_to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P11 over a list of columns."""
    return df.withColumns({c: to_double(c) for c in columns})
