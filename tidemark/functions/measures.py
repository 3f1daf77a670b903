"""Measures of runs and tables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text forms of timestamps and numbers in reports.
MILLISECOND_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
NUMBER_FORMAT = "#,##0.##"


def elapsed_us(started: Column, ended: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", started, ended)


def rows_per_second(rows: Column, elapsed: Column) -> Column:
    """Rows per second from a count and elapsed microseconds; NULL for no time."""
    return F.try_divide(rows * F.lit(1_000_000.0), elapsed)


def millisecond_text(moment: Column) -> Column:
    return F.date_format(moment, MILLISECOND_FORMAT)


def number_text(number: Column) -> Column:
    """Grouped digits with at most two decimals."""
    return F.call_function("format_number", number, F.lit(NUMBER_FORMAT))


def checksum(text: Column) -> Column:
    """CRC32 of the UTF-8 bytes, as decimal text."""
    return F.crc32(text).cast("string")


def compression_ratio(uncompressed: Column, compressed: Column) -> Column:
    """NULL where nothing is stored."""
    return F.try_divide(uncompressed, compressed)
