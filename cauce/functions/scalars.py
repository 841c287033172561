"""Column functions. All give NULL for bad input, with ANSI mode on or off."""

from pyspark.sql import Column
from pyspark.sql import functions as F

def parse_event_time(text: Column, zoned: bool = False) -> Column:
    """Text to TIMESTAMP_NTZ; text that is no timestamp gives NULL.

    The records carry wall-clock times without an offset, so the session time
    zone plays no part. With ``zoned`` an offset in the text is honoured and the
    result is the wall clock of the session time zone; a time without a date is
    no timestamp either way.
    """
    local = text.try_cast("timestamp_ntz")
    if zoned:
        return F.when(local.isNotNull(), text.try_cast("timestamp").cast("timestamp_ntz"))
    return local


def to_count(number: Column) -> Column:
    """Number to BIGINT, cut toward zero; NaN and values beyond BIGINT give NULL."""
    return number.try_cast("bigint")


def to_code(value: Column) -> Column:
    """Any value to text without surrounding spaces."""
    return F.trim(value.cast("string"))


def to_key(code: Column) -> Column:
    """Text code to INT join key: ``"05"`` gives 5, non-numbers give NULL."""
    return to_code(code).try_cast("int")


def to_name(text: Column) -> Column:
    return F.upper(F.trim(text))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE; NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator, denominator)


def rate_per_100k(events: Column, population: Column) -> Column:
    return F.round(safe_ratio(events, population) * 100000, 4)


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def count_line(label: Column, value: Column, width: int = 15) -> Column:
    """A report line: two spaces, the label padded to ``width``, the number."""
    return F.format_string(f"  %-{width}s: %d", label, value)


def is_missing(column: Column, data_type: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    if data_type in ("float", "double"):
        return column.isNull() | F.isnan(column)
    return column.isNull()
