"""Row-local expressions.  Nothing here reads data or needs Python workers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGRAL)


def col(name: str) -> Column:
    """Reference a column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores added to those that a table already has (in any case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def lenient_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """Cast to double; text that is no number becomes null (never an error)."""
    if dtype is not None and is_numeric(dtype):
        return c.cast("double")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("string").try_cast("double")


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def cap_timing(c: Column, cap_seconds: float, flag: float = -1.0) -> Column:
    """Milliseconds to seconds, capped above; the flag and nulls become the flag."""
    # ``least`` skips nulls, so null must not reach it: ``null != flag`` is null
    # and the row takes the otherwise branch.
    return F.when(c != F.lit(flag), F.least(c / F.lit(1000.0), F.lit(float(cap_seconds)))).otherwise(
        F.lit(flag)
    )


def row_mean(cols: list[Column]) -> Column:
    """Mean of the non-null values of a row; null when all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.when(present > 0, total / present)


def leading_digit(c: Column, width: int | None = None) -> Column:
    """Major group of an occupation code: its first character, as a number.

    ``width`` left-pads with zeros first, which repairs codes that were read as
    integers (``110`` with width 4 is group 0, not 1).
    """
    text = c.cast("string")
    if width is not None:
        text = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return F.substring(text, 1, 1).try_cast("bigint")


def clip(c: Column, low, high, dtype: str = "double") -> Column:
    """Clip keeping nulls; a value inside the limits is returned as it is, never by way of a double."""
    return F.when(c < F.lit(low), F.lit(low).cast(dtype)).when(c > F.lit(high), F.lit(high).cast(dtype)).otherwise(c)


def minmax_keeping_flag(c: Column, low: float, high: float, flag: float) -> Column:
    return F.when(c != F.lit(flag), (c - F.lit(low)) / F.lit(high - low)).otherwise(F.lit(flag))


def efficiency(score: Column, seconds: Column, flag: float | None = None) -> Column:
    """Score per second where the time is positive, else -1.

    With ``flag`` given, a flagged score also gives -1 instead of a small
    negative ratio.
    """
    valid = seconds > 0
    if flag is not None:
        valid = valid & (score != F.lit(flag))
    return F.when(valid, score / seconds).otherwise(F.lit(-1.0))


def number(c: Column) -> Column:
    """NaN as null: the one rule of all fits, which leave both out."""
    return F.when(~F.isnan(c.cast("double")), c)


def fast_guess(seconds: Column, below: float = 5.0) -> Column:
    return F.when((seconds > 0) & (seconds < F.lit(below)), F.lit(1.0)).otherwise(F.lit(0.0))


def order_key(id_cols: list[str], seed: int) -> Column:
    """Shuffle key: an md5 text whose order is the same on every run and engine."""
    parts = [col(c).cast("string") for c in id_cols]
    if len(parts) > 1:
        # lengths keep ("a", "b#c") and ("a#b", "c") apart; a null is no empty text
        parts = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~")) for p in parts]
    return F.md5(F.concat_ws("#", *parts, F.lit(str(seed))))


#: Hex digits of :func:`order_key` that still fit a double without rounding.
KEY_DIGITS = 13


def key_number(key: Column) -> Column:
    """The leading 52 bits of an order key as a double (same order as the text)."""
    return F.conv(F.substring(key, 1, KEY_DIGITS), 16, 10).cast("bigint").cast("double")


def right_open_bin(c: Column, edges: list[float]) -> Column:
    """1-based bin number: how many of the ascending ``edges`` are <= the value."""
    return F.when(
        c.isNotNull(),
        reduce(lambda a, b: a + b, [(c >= F.lit(float(e))).cast("int") for e in edges]),
    )


def right_closed_bin(c: Column, inner_edges: list[float]) -> Column:
    """0-based bin number: how many of the ascending ``inner_edges`` are < the value."""
    counts = [(c > F.lit(float(e))).cast("int") for e in inner_edges]
    return F.when(c.isNotNull(), reduce(lambda a, b: a + b, counts, F.lit(0)))


def tier(pct: Column) -> Column:
    """Imputation tier of a missing percentage."""
    return (
        F.when(pct > 80, "drop")
        .when(pct > 50, "complex")
        .when(pct > 20, "simple")
        .when(pct > 0, "minimal")
        .otherwise("none")
    )


#: The labels of the cardinality tiers.
TIER_LABELS = ("faible", "moyenne", "haute")


def cardinality_tier(n: Column) -> Column:
    low, mid, high = TIER_LABELS
    return F.when(n < 10, low).when(n <= 50, mid).otherwise(high)


def scale_type(n: Column, lowest: Column, highest: Column, all_integer: Column) -> Column:
    """Scale family from the distinct non-null values.

    ``n`` distinct integers are consecutive exactly when ``highest - lowest + 1 = n``.
    """
    consecutive = all_integer & (highest - lowest + 1 == n)
    return (
        F.when(n.isin(3, 4, 5, 7) & consecutive, F.concat(F.lit("likert_"), n.cast("string")))
        .when(lowest < 0, "with_special_codes")
        .when(n.between(5, 10), "quantity_ranges")
        .otherwise("other")
    )
