"""Categories of any number: a table of values with their codes, and sparse vectors of flags.

The values of all columns are ordered by range partitions; totals per partition turn
places within them into codes. Neither values nor codes pass through the driver.
"""

import os
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalar import col
from creditloom.operators.columns import stacked
from creditloom.operators.profile import distinct_values
from creditloom.sources.files import write_table

HEAVY = 1000  # a value in at least one of so many rows is looked up by broadcast; at most so many per column
_PLACES = 2**33  # monotonically_increasing_id counts the rows of a partition below this


@dataclass
class Categories:
    """Fitted categories: rows (column_name, value, n, code, position) and how many values each column has."""

    table: DataFrame
    sizes: dict

    def width(self):
        """Length of the vector of flags: a column's first value has none."""
        return sum(max(0, n - 1) for n in self.sizes.values())


def fit_categories(df, names, path):
    """The categories of text columns, stored below ``path``.

    ``code`` is the rank of a value in its column in text order, from 0; ``position`` its place in
    the vector of flags (columns in the given order), NULL for each column's first value. Missing
    values are no category; a column without values has none.
    """
    found = distinct_values(df, names).where("value IS NOT NULL")
    # written, so that a lost executor cannot move rows to other partitions between the two uses
    ordered = write_table(
        found.repartitionByRange("i", "value").sortWithinPartitions("i", "value").select(
            "i", "value", "n", F.spark_partition_id().alias("part"),
            F.pmod(F.monotonically_increasing_id(), F.lit(_PLACES)).alias("at"),
        ),
        os.path.join(path, "ordered"),
    )
    # a partition holds a range, so these are at most as many rows as partitions and columns together
    totals = ordered.groupBy("i", "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    earlier = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("i", "part", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    counted = {r.i: r.held for r in totals.groupBy("i").agg(F.sum("held").alias("held")).collect()}
    sizes = {name: counted.get(i, 0) for i, name in enumerate(names)}
    starts, start = [], 0
    for n in sizes.values():
        starts.append(start)
        start += max(0, n - 1)
    code = (F.col("at") + F.col("shift")).alias("code")
    table = ordered.join(F.broadcast(before), ["i", "part"]).select("i", "value", "n", code).select(
        F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1).alias("column_name"), "value", "n", "code",
        F.when(F.col("code") > 0, F.element_at(F.array(*[F.lit(s) for s in starts]).cast("array<bigint>"), F.col("i") + 1)
               + F.col("code") - 1).alias("position"),
    )
    return Categories(write_table(table, os.path.join(path, "categories")), sizes)


def load_categories(spark, path, names):
    """Categories stored by ``fit_categories`` for the same columns."""
    table = spark.read.parquet(os.path.join(path, "categories"))
    counted = {r.column_name: r.n for r in table.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    return Categories(table, {name: counted.get(name, 0) for name in names})


def flag_vectors(df, categories, path, output="flags"):
    """``df`` with one sparse vector of flags in place of the category columns, stored below ``path``.

    A row has a 1 at the position of each of its values; missing values, a column's first value and values
    that were not there when fitted have none. Repeated rows stay. Values in a thousandth of the rows
    or more meet their codes by broadcast (at most ``HEAVY`` a column, by a digest of 16 bytes), so that no hot
    value is shuffled; the others by a join on the value.
    """
    names, spark = list(categories.sizes), df.sparkSession
    kept = [c for c in df.columns if c not in names and c != output]
    # row numbers are stored with the rows, so every later use sees the same
    rows = write_table(
        df.select(*[col(c) for c in kept + names]).withColumn("_row", F.monotonically_increasing_id()), os.path.join(path, "rows")
    )
    width = categories.width()
    if width >= 2**31:
        raise ValueError(f"{width} flags are more than a vector can index")
    column = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1)
    pairs = stacked(rows, [col(c) for c in names], keep=["_row"]).where("x IS NOT NULL").select(
        "_row", column.alias("column_name"), F.col("x").alias("value")
    )
    known = categories.table.join(
        F.broadcast(categories.table.groupBy("column_name").agg(F.sum("n").alias("total"))), "column_name"
    )
    digest = F.unhex(F.md5(F.col("value").cast("binary"))).alias("digest")
    heavy = F.broadcast(known.where(F.col("n") * HEAVY >= F.col("total")).select("column_name", digest, "code", "position"))
    light = known.where(F.col("n") * HEAVY < F.col("total")).select("column_name", "value", "position")
    looked_up = pairs.withColumn("digest", digest).join(heavy, ["column_name", "digest"], "left")
    found = looked_up.where("code IS NOT NULL").select("_row", "position").union(
        looked_up.where("code IS NULL").select("_row", "column_name", "value").join(
            light, ["column_name", "value"]).select("_row", "position")
    ).where("position IS NOT NULL")
    places = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.col("position").cast("int"))).alias("places"))
    at = F.coalesce("places", F.array().cast("array<int>"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"), at.alias("indices"),
        F.transform(at, lambda _: F.lit(1.0)).alias("values"),
    )
    stored = rows.join(places, "_row", "left").select(*[col(c) for c in kept], vector.alias(output))
    target = os.path.join(path, "flagged")
    stored.write.mode("overwrite").parquet(target)
    # the struct is the stored form of a vector; the schema says so when it is read
    fields = [rows.schema[c] for c in kept]
    return spark.read.schema(T.StructType([*fields, T.StructField(output, VectorUDT())])).parquet(target)
