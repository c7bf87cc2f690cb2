"""Statistics of many columns through one long form.

A table several hundred columns wide would need an aggregate with thousands of
buffers, too large for generated code. Instead every row is unfolded into
(i, x) pairs, one per column, and grouped by the column's number: a small plan,
combined in each task to one line per column before anything is shuffled. Sums
and bounds need no pairs: a task adds up its Arrow columns.
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

Facts = namedtuple("Facts", "n low high")


def stacked(df, columns, keep=()):
    """Rows (i, x) for every row and every expression, beside the columns to keep."""
    return df.select(*keep, F.posexplode(F.array(*columns)).alias("i", "x"))


def number_facts(df, columns):
    """Per name the count, minimum and maximum of the present values, read as doubles."""
    if not columns:
        return {}
    width = len(columns)

    def bounds(batches):
        n, low, high = [0] * width, [None] * width, [None] * width
        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy()
                if len(x):
                    # not-a-number counts as the largest value
                    least, most = np.fmin.reduce(x), np.max(x)
                    low[i] = least if n[i] == 0 else np.fmin(low[i], least)
                    high[i] = most if n[i] == 0 else np.maximum(high[i], most)
                    n[i] += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(n, pa.int64()), pa.array(low, pa.float64()),
             pa.array(high, pa.float64())], names=["i", "n", "low", "high"],
        )

    # a line per task and column is all that leaves the tasks
    values = df.select([c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())])
    found = values.mapInArrow(bounds, "i int, n long, low double, high double").groupBy("i").agg(
        F.sum("n"), F.min("low"), F.max("high")
    )
    facts = {row[0]: Facts(*row[1:]) for row in found.collect()}
    return {name: facts.get(i, Facts(0, None, None)) for i, name in enumerate(columns)}


def label_moments(df, columns, label):
    """Rows (i, n, xx, yy, xy): of each column the rows where it and the label are present, and their sums of squared deviations.

    A side of one value has exactly 0. Tasks add up deviations from their own means, which are then moved to those of all.
    """
    width = len(columns)

    def moments(batches):
        sums = np.zeros((width, 6))  # n, means and sums of products of deviations
        bounds = np.full((width, 4), np.nan)
        for batch in batches:
            y_all = batch.column(0)
            for i, column in enumerate(batch.columns[1:]):
                both = column.is_valid().to_numpy(zero_copy_only=False) & y_all.is_valid().to_numpy(zero_copy_only=False)
                x, y = (c.to_numpy(zero_copy_only=False)[both] for c in (column, y_all))
                m = len(x)
                if not m:
                    continue
                mx, my = x[0] + np.mean(x - x[0]), y[0] + np.mean(y - y[0])
                dx, dy = x - mx, y - my
                n, ax, ay, xx, yy, xy = sums[i]
                to_x, to_y, share = mx - ax, my - ay, n * m / (n + m)
                sums[i] = (n + m, ax + to_x * m / (n + m), ay + to_y * m / (n + m), xx + dx @ dx + to_x**2 * share,
                           yy + dy @ dy + to_y**2 * share, xy + dx @ dy + to_x * to_y * share)
                ends = np.array([x.min(), -x.max(), y.min(), -y.max()])
                bounds[i] = ends if n == 0 else np.minimum(bounds[i], ends)
        some = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), *(pa.array(c) for c in sums[some].T), *(pa.array(c) for c in bounds[some].T)],
            names=["i", "n", "ax", "ay", "xx", "yy", "xy", "x_low", "x_high", "y_low", "y_high"],
        )

    values = df.select(label.cast("double").alias("y"), *[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    kinds = "i int, n double, ax double, ay double, xx double, yy double, xy double, x_low double, x_high double, y_low double, y_high double"
    # a line per task and column from here on
    of_all = Window.partitionBy("i")
    mean = lambda c: F.sum(F.col(c) * F.col("n")).over(of_all) / F.sum("n").over(of_all)
    parts = values.mapInArrow(moments, kinds).withColumns({"to_x": F.col("ax") - mean("ax"), "to_y": F.col("ay") - mean("ay")})
    moved = lambda c, a, b: F.sum(F.col(c) + F.col("n") * F.col(a) * F.col(b))
    varies = lambda side: F.min(f"{side}_low") != -F.min(f"{side}_high")
    return parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.when(varies("x"), moved("xx", "to_x", "to_x")).otherwise(0.0).alias("xx"),
        F.when(varies("y"), moved("yy", "to_y", "to_y")).otherwise(0.0).alias("yy"), moved("xy", "to_x", "to_y").alias("xy"),
    )
