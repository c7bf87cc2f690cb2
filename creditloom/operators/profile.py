"""Profiles of tables: missing values, distinct values, rates by segment, correlations, histograms."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import settings as S
from creditloom.functions import bands
from creditloom.functions.scalar import clip, col
from creditloom.operators.columns import label_moments, number_facts, stacked
from creditloom.operators.quantiles import quantiles
from creditloom.session import small_table


def numeric_columns(df, without=()):
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in without]


def string_columns(df, without=()):
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in without]


def _facts(spark, rows, schema):
    """A report of per-column facts; its rows are as many as the profiled table has columns."""
    return small_table(spark, rows, schema)


def _named(columns):
    """The name of column ``i`` of a stacked table."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)


def _all_named(found, columns, **absent):
    """``found`` (by i) with a row for each of the columns; ``absent`` are the values of those it lacks."""
    every = found.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("i"))
    rows = every.join(F.broadcast(found), "i", "left")
    return rows.select(_named(columns).alias("column_name"), *[
        F.coalesce(c, F.lit(value)).alias(c) if value is not None else F.col(c) for c, value in absent.items()
    ])


def missing_counts(df, columns=None):
    """Rows (column_name, missing, n): missing values and rows of each column; none for an empty table."""
    names = columns or df.columns
    return stacked(df, [col(c).isNull() for c in names]).groupBy("i").agg(
        F.count("*").alias("n"), F.count_if("x").alias("missing")
    ).select(_named(names).alias("column_name"), "missing", "n")


def missing_profile(df, columns=None):
    """Columns with missing values, their count and percentage, most missing first."""
    return missing_counts(df, columns).where("missing > 0").select(
        "column_name",
        F.col("missing").alias("missing_count"),
        F.bround(F.col("missing") / F.col("n") * 100, 2).alias("missing_pct"),
    ).orderBy(F.desc("missing_pct"), "column_name")


def distinct_values(df, columns):
    """Rows (i, value, n) over the values of the i-th string column, missing among them.

    The long form lets Spark combine equal values in each task and spread the
    distinct ones, so no buffer grows with a column's cardinality.
    """
    return stacked(df, [col(c) for c in columns]).groupBy("i", F.col("x").alias("value")).agg(
        F.count("*").alias("n")
    )


def distinct_counts(df, columns=None):
    """Number of distinct present values per string column."""
    names = columns or string_columns(df)
    found = distinct_values(df, names).groupBy("i").agg(F.count("value").alias("distinct_values"))
    return _all_named(found, names, distinct_values=0)


def rate_by(df, segment, labels, label=S.LABEL):
    """Default rate in percent per segment in segment order; rows outside all segments are left out."""
    return (
        df.where(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg((F.avg(label) * 100).alias("default_rate_pct"))
        .orderBy(bands.position(F.col(segment), labels))
    )


def exploration_segments(df):
    """Segments cut again from the prepared values, as the reports use them."""
    return df.withColumns({
        "age_group": bands.age_group(F.col("age_years")),
        "employment_group": bands.employment_group(F.col("employment_age_ratio")),
        "income_group": bands.income_group(F.col("AMT_INCOME_TOTAL")),
    })


def rate_by_age(df):
    return rate_by(df, "age_group", S.AGE_LABELS)


def rate_by_employment(df):
    return rate_by(df, "employment_group", S.EMPLOYMENT_LABELS)


def rate_by_income(df):
    return rate_by(df, "income_group", S.INCOME_LABELS)


def rate_grid(df, label=S.LABEL):
    """Default rate in percent, age rows by employment columns."""
    grid = (
        df.where(F.col("age_group").isNotNull() & F.col("employment_group").isNotNull())
        .groupBy("age_group")
        .pivot("employment_group", S.EMPLOYMENT_LABELS)
        .agg(F.avg(label) * 100)
    )
    return grid.orderBy(bands.position(F.col("age_group"), S.AGE_LABELS))


def set_profile(df, label=S.LABEL, tag=S.SET):
    """Rows per set and the default rate of the labelled one."""
    labelled = F.col(tag) == "train"
    return df.agg(
        F.count_if(labelled).alias("train_rows"),
        F.count_if(F.col(tag) == "test").alias("test_rows"),
        (F.avg(F.when(labelled, F.col(label))) * 100).alias("default_rate_pct"),
    )


def label_correlations(df, columns, label=S.LABEL):
    """Correlation of each column with the label, rows (feature, correlation)."""
    found = label_moments(df, [col(c) for c in columns], F.col(label))
    # a constant or single-row column has no correlation
    correlation = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    return found.select(_named(columns).alias("feature"), correlation.alias("correlation"))


def top_correlations(df, columns=None, label=S.LABEL, k=S.TOP_CORRELATIONS):
    """The k features most correlated with the label by absolute value."""
    names = columns or numeric_columns(df, without=[label])
    return (
        label_correlations(df, names, label)
        .where(F.col("correlation").isNotNull())
        .select("feature", F.abs("correlation").alias("abs_correlation"))
        # correlations equal but for the last digits count as equal
        .orderBy(F.desc(F.bround("abs_correlation", 10)), "feature")
        .limit(k)
    )


def class_histogram(df, features=None, label=S.LABEL, bins=S.HISTOGRAM_BINS):
    """Density of each feature per class over shared equal-width bins.

    Bins run from the minimum to the 99th percentile of both classes together
    (to the maximum if these coincide; a feature without spread gets a range of
    one around its value); values are clipped and the last bin is closed. Empty
    bins have density 0. Features without values are left out.
    """
    names = [c for c in (features or S.BEHAVIOURAL) if c in df.columns]
    labelled = df.where(F.col(label).isin(0, 1))
    columns = {c: col(c).cast("double") for c in names}
    facts = {c: fact for c, fact in number_facts(labelled, columns).items() if fact.n}
    columns = {c: columns[c] for c in facts}
    upper = quantiles(labelled, columns, [0.99], facts)

    spans = {}
    for c, fact in facts.items():
        top = upper[c][0] if upper[c][0] > fact.low else fact.high
        spans[c] = (fact.low, top) if top > fact.low else (fact.low - 0.5, fact.low + 0.5)
    if not spans:
        return _facts(df.sparkSession, [], "feature string, label int, bin int, n long, density double")

    def placed(name):
        low, high = spans[name]
        width = (high - low) / bins
        x = clip(columns[name], low, high)
        guess = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        edge = lambda k: F.lit(low) + k * F.lit(width)
        # division may round across an edge; the edges themselves decide
        settled = F.when(x < edge(guess), guess - 1).when(
            (guess < bins - 1) & (x >= edge(guess + 1)), guess + 1
        ).otherwise(guess)
        return F.struct(
            F.lit(name).alias("feature"), settled.cast("int").alias("bin"), F.lit(width).alias("width")
        )

    counted = (
        labelled.select(F.col(label).cast("int").alias("label"), F.explode(F.array(*map(placed, spans))).alias("p"))
        .select("label", "p.*").where(F.col("bin").isNotNull())
        .groupBy("feature", "label", "bin", "width").agg(F.count("*").alias("n"))
    )
    # at most features x 2 x bins rows from here on
    sizes = counted.groupBy("feature", "label").agg(F.sum("n").alias("size"), F.any_value("width").alias("width"))
    every = sizes.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce("n", F.lit(0))
    return every.join(counted.drop("width"), ["feature", "label", "bin"], "left").select(
        "feature", "label", "bin", n.alias("n"), (n / (F.col("size") * F.col("width"))).alias("density")
    )


def class_counts(df, label=S.LABEL):
    """Rows per class as a small dict."""
    counted = df.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("c")).count()
    found = {row["c"]: row["count"] for row in counted.collect()}
    return {c: found.get(c, 0) for c in (0, 1)}


def class_weights(df, label=S.LABEL):
    """Balanced weight per class, n / (2 n_c), and the weight of a positive, n_0 / n_1."""
    n0, n1 = F.col("n0"), F.col("n1")
    counted = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    return counted.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("label"), n.alias("n"), (F.try_divide(n0 + n1, 2 * n)).alias("balanced_weight"),
        weight.alias("positive_weight"),
    ) for c, n, weight in ((0, n0, F.lit(1.0)), (1, n1, F.try_divide(n0, n1)))]))).where("n > 0")


def minmax(df, columns):
    """Smallest and largest value per column; NULL for a column without values."""
    found = stacked(df, [col(c).cast("double") for c in columns]).groupBy("i").agg(
        F.min("x").alias("min_value"), F.max("x").alias("max_value")
    )
    return _all_named(found, columns, min_value=None, max_value=None)


def quantile_report(df, columns, shares):
    """Exact quantiles as rows (column_name, share, value)."""
    found = quantiles(df, {c: col(c) for c in columns}, shares)
    rows = [(c, float(share), value) for c in columns for share, value in zip(shares, found[c])]
    return _facts(df.sparkSession, rows, "column_name string, share double, value double")
