"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 48


def lenient_double(name: str, data_type: T.DataType) -> Column:
    """``name`` as double; text that is no number, and NaN, become NULL.

    Spark reads Java's number suffixes and hexadecimal floats (``1d``, ``1f``, ``0x1p3``) as
    numbers. They are not numbers here, so text with a ``d`` or ``x`` in it is refused, and text
    that ends in ``f`` unless it is ``inf``.
    """
    source = F.col(f"`{name}`")
    if isinstance(data_type, T.StringType):
        holds, text = source.contains, F.lower(F.trim(source))
        float_suffix = (
            (holds("f") | holds("F")) & text.endswith("f") & ~text.endswith("inf")
        )
        suffixed = holds("d") | holds("D") | holds("x") | holds("X") | float_suffix
        number = F.when(~suffixed, source.try_cast("double"))
    else:
        number = source.try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def strict_long(name: str) -> Column:
    """``name`` as bigint, cut towards zero; a missing or unusable value stops the query.

    Text may hold a whole number of any size that fits, or a number with a fraction.

    The check is part of the value itself, so it cannot be pruned away while the value is in use.
    """
    source = F.col(f"`{name}`")
    shown = F.coalesce(source.cast("string"), F.lit("NULL"))
    message = F.concat(F.lit(f"column {name} holds a value that is no integer: "), shown)
    # Text such as 5.0 is no bigint, but a double; an infinite one is neither.
    number = F.coalesce(source.try_cast("bigint"), source.try_cast("double").try_cast("bigint"))
    return F.coalesce(number, F.raise_error(message).cast("bigint"))


def present_double(name: str) -> Column:
    """``name`` as double; a missing value stops the query and the error names the column."""
    number = F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))
    message = F.lit(f"column {name} has a missing value")
    return F.coalesce(number, F.raise_error(message).cast("double"))


def utc_now() -> Column:
    """The time of the query, the same on every row.

    A timestamp is an instant, so it needs no conversion to UTC.
    """
    return F.current_timestamp()


def absolute_error(actual: str | Column, predicted: str | Column) -> Column:
    """Distance between a true and a predicted value."""
    actual = F.col(actual) if isinstance(actual, str) else actual
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    return F.abs(actual - predicted)


def key_digest(key: str, seed: int) -> Column:
    """Hex md5 of seed and key: the same on every engine, whatever the partitioning.

    A missing key stops the query, since its row would belong to no part of a split.
    """
    missing = F.raise_error(F.lit(f"key column {key} has a missing value")).cast("string")
    text = F.coalesce(F.col(f"`{key}`").cast("string"), missing)
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def digest_number(digest: Column) -> Column:
    """First 48 bits of a hex digest as a bigint; sorts like the digest itself."""
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")
