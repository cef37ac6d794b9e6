"""Tolerant access to loan columns.

An absent column becomes a literal default at plan time, unparsable text
becomes NULL, and NaN becomes NULL, so NULL is the only missing value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def quoted(name: str) -> Column:
    """A column by its literal name, also when that holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def opt_col(df: DataFrame, name: str, default=None, dtype: str = "string") -> Column:
    return quoted(name) if name in df.columns else F.lit(default).cast(dtype)


def num(df: DataFrame, name: str, default: float | None = None) -> Column:
    """A column as DOUBLE; text that is no number, NaN and NULL give ``default``."""
    if name not in df.columns:
        return F.lit(default).cast("double")
    raw, kind = quoted(name), df.schema[name].dataType
    value = raw if isinstance(kind, T.DoubleType) else raw.try_cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.StringType)):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL or NaN in the raw column; an absent column is missing everywhere."""
    if name not in df.columns:
        return F.lit(True)
    raw = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return raw.isNull() | F.isnan(raw)
    return raw.isNull()


def status(df: DataFrame) -> Column:
    """Loan status trimmed and lower-cased; missing is the empty string."""
    text = F.coalesce(opt_col(df, "loan_status").cast("string"), F.lit(""))
    return F.lower(F.btrim(text, F.lit(" \t\n\r\f\x0b")))


def is_yes(df: DataFrame, name: str) -> Column:
    return F.upper(F.coalesce(opt_col(df, name).cast("string"), F.lit(""))) == "Y"


def month(df: DataFrame, name: str) -> Column:
    """``Mon-YYYY`` text as the first day of that month, NULL when unparsable."""
    if name in df.columns and isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.trunc(quoted(name), "month")
    return F.try_to_date(opt_col(df, name).cast("string"), "MMM-yyyy")


def term_months(df: DataFrame) -> Column:
    digits = F.regexp_extract(opt_col(df, "term").cast("string"), "([0-9]+)", 1)
    return F.coalesce(digits.try_cast("double"), F.lit(36.0))


def clamp(value: Column, low=None, high=None) -> Column:
    """Clip of a value that is never NULL (``greatest``/``least`` skip NULL)."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return out


def within(value: Column, low=None, high=None) -> Column:
    """Clip that keeps NULL."""
    return F.when(value.isNotNull(), clamp(value, low, high))


def true_or_false(mask: Column) -> Column:
    """A predicate in which an unknown comparison counts as false."""
    return F.coalesce(mask, F.lit(False))


def any_of(masks: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, masks)


def lookup(key: Column, mapping: dict, default=None) -> Column:
    """Value of a small fixed map, ``default`` for keys outside it."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, key.cast("int"))
    return found if default is None else F.coalesce(found, F.lit(default))


def first_max_position(values: list[Column]) -> Column:
    """Zero-based position of the first largest value."""
    return (F.array_position(F.array(*values), F.greatest(*values)) - 1).cast("int")


def half_even(value: Column, digits: int) -> Column:
    """Half-even rounding of the double itself: scale, round, scale back."""
    return F.rint(value * 10.0 ** digits) / 10.0 ** digits if digits else F.rint(value)


def month_gap(start: Column, end: Column) -> Column:
    """Months between two month columns (first days, so a whole number)."""
    return F.months_between(end, start, False).cast("int")


def shuffle_key(key: Column, seed: int) -> Column:
    """Reproducible pseudo-random hex text per key."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def unit_draw(seed: int, *parts: Column) -> Column:
    """Reproducible number in [0, 1) per combination of ``parts``."""
    return F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
