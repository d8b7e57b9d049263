"""Column functions.  All of them are JVM expressions; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.fixed_values import DATE_FORMAT, MISSING_INT, WORD_SEPARATOR


def epoch_seconds(timestamp: Column) -> Column:
    """Seconds since the epoch of a timestamp, with or without a time zone."""
    return F.unix_timestamp(timestamp.cast("timestamp"))


def day_of_epoch(seconds: Column) -> Column:
    """Calendar day of epoch seconds as a DATE: four bytes, cheap to group by."""
    return F.timestamp_seconds(seconds).cast("date")


def epoch_date(seconds: Column, fmt: str = DATE_FORMAT) -> Column:
    """Calendar day of epoch seconds as text, in the session time zone."""
    if fmt == DATE_FORMAT:
        # Same text as the formatter gives, without running a formatter per row.
        return day_of_epoch(seconds).cast("string")
    return F.from_unixtime(seconds, fmt)


def first_title(text: Column) -> Column:
    """First run of letters followed by a dot; empty text when there is none.

    Matches what ``TITLE_PATTERN`` matches.  That pattern tries every start inside
    a run of letters again, which is quadratic in the length of the run; a match
    can only begin where a run begins, and the run never has to give letters back,
    so the form below finds the same match in linear time.
    """
    return F.regexp_extract(text, r"(?<![A-Za-z])([A-Za-z]++)\.", 1)


def words(text: Column) -> Column:
    """Split on white space.  Leading or trailing blanks give an empty word."""
    return F.split(text.cast("string"), WORD_SEPARATOR)


def hash_bucket(*keys: Column, buckets: int = 100) -> Column:
    """Bucket number of a key that does not depend on the partition layout."""
    text = F.concat_ws("\x1f", *[k.cast("string") for k in keys])
    digits = F.substring(F.md5(text), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % F.lit(buckets)


def parse_token(token: Column, type_tag: str, dash_as: int | None = MISSING_INT) -> Column:
    """Typed value of a text token; null where the token is not of that type.

    ``int``: a dash anywhere in the token means missing and gives ``dash_as``; with
    ``dash_as=None`` negative numbers are kept.  ``double``: a decimal number.  Any
    other tag leaves the text as it is.
    """
    if type_tag == "int":
        number = token.try_cast("int")
        if dash_as is None:
            return number
        return F.when(F.contains(token, F.lit("-")), F.lit(dash_as)).otherwise(number)
    if type_tag == "double":
        # A cast accepts a Java type suffix ("1.5f"); as data that is not a number.
        suffixed = token.rlike(r"[0-9.][dDfF]\s*$")
        return F.when(~suffixed, token.try_cast("double"))
    return token
