"""Column expressions shared by the models. All are built-ins: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD_START = r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}])"
_MARK = "\ufdd0 "  # a Unicode non-character and the space that Spark's initcap reacts to


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy(c: Column | str) -> Column:
    """Strip surrounding spaces (0x20 only)."""
    return F.trim(_col(c))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(tidy(c), F.lit(""))


def whole_number(c: Column | str) -> Column:
    """Text to int. Blank is NULL, anything malformed raises."""
    return blank_to_null(c).cast("int")


def money(c: Column | str) -> Column:
    """Text to decimal(12,2), half away from zero. Blank is NULL, malformed text raises."""
    return blank_to_null(c).cast("decimal(12,2)")


def parse_ts(c: Column | str) -> Column:
    """Raw text in either accepted layout to a wall-clock timestamp; blank is NULL.

    Layouts: ``2024-01-01 10:00:00`` and ``2024-01-01T10:00:00Z``.
    """
    plain = F.translate(F.rtrim(tidy(c), F.lit("Z")), "T", " ")
    return F.nullif(plain, F.lit("")).cast("timestamp_ntz")


def initcap_words(c: Column | str) -> Column:
    """Capitalise after every non-alphanumeric character: ``D'Oeste``, ``São-Paulo``.

    Spark's ``initcap`` only starts a word after a space, so a removable marker that ends in
    a space goes in front of every word first. Unlike a higher-order function over the
    letters this stays inside generated code.
    """
    marked = F.regexp_replace(_col(c), _WORD_START, _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def zip5(c: Column | str) -> Column:
    """Left-pad with zeros to five characters; longer text is cut to five."""
    return F.lpad(tidy(c), 5, "0")


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Exact decimal quotient, rounded once, half away from zero. NULL when dividing by 0.

    ``avg`` on decimals keeps only four more digits than its input, and the quotient of two
    wide decimals loses digits as well; rounding such a value again can go wrong. These two
    widths leave 18 decimal places, which no count below 10^15 can push over a boundary.
    """
    quotient = numerator.cast("decimal(22,2)") / F.nullif(
        denominator.cast("decimal(15,0)"), F.lit(0).cast("decimal(15,0)")
    )
    return F.round(quotient, digits)


def days_between(start: str, end: str, digits: int = 1) -> Column:
    """Elapsed days with ``digits`` decimals, from microseconds, never through a double."""
    micros = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    return F.round(micros.cast("decimal(20,0)") / F.lit(86_400_000_000), digits)


def utc_wall_clock(c: Column | str) -> Column:
    """An instant as the wall clock shows it in UTC (the session runs in UTC)."""
    return _col(c).cast("timestamp_ntz")
