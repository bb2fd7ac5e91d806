"""Column expressions for text, numbers and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: ColumnOrName) -> Column:
    """Trimmed lower-case text."""
    return F.lower(F.trim(_col(c)))


def parse_number(c: ColumnOrName, to: str = "int") -> Column:
    """Text to an integer type; bad text gives NULL instead of an ANSI error.

    A fraction is cut off ("12.7" is 12), as a non-ANSI cast does.
    """
    return F.regexp_replace(F.trim(_col(c)), r"(?<=\d)\.\d*$", "").try_cast(to)


def parse_grouped_number(c: ColumnOrName, to: str = "bigint") -> Column:
    """Text with thousands separators ("264,738,322,692") to an integer type."""
    return parse_number(F.replace(_col(c), F.lit(","), F.lit("")), to)


def is_rejected(raw: ColumnOrName, parsed: ColumnOrName) -> Column:
    """True where a text was given but could not be parsed."""
    return F.trim(_col(raw)).isNotNull() & _col(parsed).isNull()


def title_case(c: ColumnOrName) -> Column:
    """Title case for display. Only blanks start a new word ("D'artagnan")."""
    return F.initcap(_col(c))


def show_timestamp(c: ColumnOrName) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def show_amount(c: ColumnOrName, decimals: int = 2) -> Column:
    """Number with thousands separators, e.g. 1,234.50."""
    return F.format_number(_col(c), decimals)
