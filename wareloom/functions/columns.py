"""Scalar expressions. Everything here stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareloom.schema import NULL_TOKENS, WEEKDAY_LABELS

# The two textual time layouts of the data. The fraction has one to nine digits.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS'Z'"
CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed value: the characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

WHOLE_NUMBER = r"^-?[0-9]+\z"
DIGITS_ONE_DOT = r"^([0-9]+\.?[0-9]*|\.[0-9]+)\z"


def strip(c: Column) -> Column:
    """Remove any surrounding whitespace (plain ``trim`` would only remove spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def blank_to_null(c: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Texts that stand for a missing value, compared exactly."""
    return F.when(~c.isin(*tokens), c)


def parse_text_time(c: Column, clock: bool) -> Column:
    """Quoted or padded time text; whole numbers are milliseconds since the epoch.

    Anything unparsable becomes null.
    """
    text = strip(F.replace(c, F.lit('"'), F.lit("")))
    parsed = F.try_to_timestamp(text, F.lit(CLOCK_FORMAT if clock else STAMP_FORMAT))
    return F.when(text.rlike(WHOLE_NUMBER), millis_time(text.try_cast("bigint"))).otherwise(parsed)


def millis_time(c: Column) -> Column:
    return F.timestamp_millis(c)


def hours_between(start: Column, end: Column) -> Column:
    """Whole seconds between two times, in hours."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)


def is_digit_text(c: Column) -> Column:
    return c.rlike(DIGITS_ONE_DOT)


def weekday_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def weekday_label(c: Column) -> Column:
    pairs = [F.lit(part) for pair in WEEKDAY_LABELS.items() for part in pair]
    return F.create_map(*pairs)[weekday_name(c)]


def log_amount(c: Column, keep_infinite: bool = False) -> Column:
    """Natural logarithm; zero gives null, or minus infinity on request."""
    value = F.when(c > 0, F.ln(c))
    if keep_infinite:
        value = F.when(c == 0, F.lit(float("-inf"))).otherwise(value)
    return value


def amount(price: Column, quantity: Column) -> Column:
    return price * quantity


def hash_text(key: Column, seed: int) -> Column:
    """Uniform, repeatable 32-digit text per key; the same on every engine. Null counts as an empty key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hash_unit(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) from the first 13 hexadecimal digits (52 bits)."""
    digits = F.conv(F.substring(hash_text(key, seed), 1, 13), 16, 10)
    return digits.cast("double") / F.lit(float(16**13))
