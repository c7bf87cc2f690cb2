"""Aggregate builders with the engine's rules for empty groups."""

from pyspark.sql import functions as F


def total(column):
    """Sum; a group without values sums to 0."""
    return F.coalesce(F.sum(column), F.lit(0))


STATISTICS = {
    "count": F.count,
    "sum": total,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "rows": F.count_if,
}


def correlation(x, y):
    """Pearson correlation over the rows where both values are present.

    A constant or single-row column gives NULL instead of an ANSI division error.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_samp(F.when(both, x)) * F.stddev_samp(F.when(both, y))
    return F.try_divide(F.covar_samp(x, y), spread)
