"""Binning of numbers into labels."""

from functools import reduce

from pyspark.sql import functions as F

from creditloom import settings as S

_INSIDE = {
    "right": lambda x, low, high: (x > low) & (x <= high),
    "left": lambda x, low, high: (x >= low) & (x < high),
}


def band(column, edges, labels, closed="right"):
    """Label of the bin holding the value; NULL outside the edges or for a missing value."""
    inside = _INSIDE[closed]
    spans = zip(edges, edges[1:], labels)
    return reduce(
        lambda chain, span: chain.when(
            inside(column, F.lit(float(span[0])), F.lit(float(span[1]))), span[2]
        ),
        spans,
        F,
    )


def position(column, labels):
    """Place of a label in its order, for sorting reports."""
    return F.array_position(F.array(*[F.lit(v) for v in labels]), column)


def age_group(years):
    return band(years, S.AGE_EDGES, S.AGE_LABELS)


def employment_group(ratio):
    return band(ratio, S.EMPLOYMENT_EDGES, S.EMPLOYMENT_LABELS)


def income_group(income):
    return band(income, S.INCOME_EDGES, S.INCOME_LABELS, closed="left")


def loan_size(credit):
    return band(credit, S.LOAN_EDGES, S.LOAN_LABELS, closed="left")


def risk_level(ratio):
    return band(ratio, S.RISK_EDGES, S.RISK_LABELS)


def _below(column, edges, labels):
    # The mart's bands have no lower edge and compare with "<"; the last label takes the rest.
    chain = reduce(
        lambda c, span: c.when(column < F.lit(float(span[0])), span[1]),
        zip(edges[1:-1], labels),
        F,
    )
    return chain.otherwise(labels[-1])


def mart_age_band(days_birth):
    return _below(days_birth.cast("double") / F.lit(365.0), S.AGE_EDGES, S.AGE_LABELS)


def mart_employment_band(ratio):
    """A missing ratio counts as unstable."""
    return F.when(ratio.isNull(), S.EMPLOYMENT_LABELS[0]).otherwise(
        _below(ratio, S.EMPLOYMENT_EDGES, S.EMPLOYMENT_LABELS)
    )
