"""Scalar column builders with the engine's rules for missing values."""

from pyspark.sql import functions as F

from creditloom.settings import DAYS_PER_YEAR, DAYS_SENTINEL


def quoted(name):
    return "`" + name.replace("`", "``") + "`"


def unquoted(name):
    return name[1:-1].replace("``", "`")


def col(name):
    """A column by its exact name, also when one-hot values put dots or spaces into it."""
    return F.col(quoted(name))


def nan_to_null(column):
    return F.nanvl(column, F.lit(None).cast("double"))


def sentinel_to_null(column, sentinel=DAYS_SENTINEL):
    return F.nullif(column, F.lit(sentinel))


def flag(condition):
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(numerator, denominator):
    """Quotient as double, NULL on a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or(numerator, denominator, fill=0.0):
    """Quotient as double, ``fill`` on a zero denominator; a missing operand stays missing."""
    bottom = denominator.cast("double")
    return F.when(bottom == 0.0, F.lit(float(fill))).otherwise(ratio(numerator, bottom))


def years(days):
    return F.abs(days).cast("double") / F.lit(float(DAYS_PER_YEAR))


def clip(column, low, high):
    """Bounded value; missing stays missing, as ``greatest``/``least`` skip NULLs."""
    low = low if hasattr(low, "cast") else F.lit(low)
    high = high if hasattr(high, "cast") else F.lit(high)
    return F.when(column.isNotNull(), F.least(F.greatest(column, low), high))


def column_or(df, name, default):
    """The named column, or a constant where the table does not have it."""
    return col(name) if name in df.columns else F.lit(default)
