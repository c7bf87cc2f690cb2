"""File scans and sinks, stage tables, typed load and view resolution."""

import hashlib
import json
import os

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalar import col, nan_to_null
from creditloom.operators.columns import stacked
from creditloom.session import path_exists
from creditloom.settings import CUSTOMER, SLIM_COLUMNS
from creditloom.sources import schemas

# Cell texts a CSV scan reads as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
# A quote inside a quoted cell is doubled, as spreadsheets and data frames write it.
CSV_QUOTES = {"quote": '"', "escape": '"'}
# Cells are written with the blanks and line breaks at their ends.
CSV_WHOLE_CELLS = {**CSV_QUOTES, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _present(name):
    """The cell's text, NULL for the texts that mean missing."""
    return F.when(~col(name).isin(NULL_TOKENS), col(name))


def whole_number(text, kind, name):
    """Text as a whole number; it may be written with a decimal point, but a fraction is an error, not cut off."""
    number = text.cast("double")
    refused = F.raise_error(F.concat(F.lit(f"fraction in the whole-number column {name}: "), text))
    return F.coalesce(
        text.try_cast("bigint"),
        F.when(number.isNotNull(), F.when(number == F.floor(number), number.cast("bigint")).otherwise(refused.cast("bigint"))),
    ).cast(kind)


def infer_kinds(raw, names):
    """Type per text column from its present cells, in one aggregate: boolean, int, bigint, double or string.

    A column without cells is a double, like one of missing numbers.
    """
    found = stacked(raw, [_present(c) for c in names]).where("x IS NOT NULL").groupBy("i").agg(
        F.every(F.col("x").isin("True", "False", "TRUE", "FALSE", "true", "false")).alias("boolean"),
        F.every(F.col("x").try_cast("int").isNotNull() & ~F.col("x").contains(".")).alias("int"),
        F.every(F.col("x").try_cast("bigint").isNotNull() & ~F.col("x").contains(".")).alias("bigint"),
        F.every(F.col("x").try_cast("double").isNotNull() & ~F.lower("x").rlike("[df]$")).alias("double"),
    )
    facts = {row.i: row for row in found.collect()}
    types = {"boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}

    def kind(i):
        if i not in facts:
            return T.DoubleType()
        return next((t for name, t in types.items() if facts[i][name]), T.StringType())

    return {name: kind(i) for i, name in enumerate(names)}


def csv_text(spark, path):
    """Header CSV with every cell as text; quoted cells may hold line breaks.

    A record spans lines in just those files that have a line with an odd number
    of quotes, which one scan of the lines finds. These files are parsed whole, a
    task each; the others can be split.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = spark.read.text(path).where(quotes % 2 == 1).select("_metadata.file_path").distinct().collect()
    if not found:
        return spark.read.csv(path, header=True, **CSV_QUOTES)
    spanning = F.col("_metadata.file_path").isin([row.file_path for row in found])
    whole = spark.read.csv(path, header=True, multiLine=True, **CSV_QUOTES)
    lines = spark.read.schema(whole.schema).csv(path, header=True, **CSV_QUOTES)
    return lines.where(~spanning).unionByName(whole.where(spanning))


def read_csv(spark, path, schema=None, columns=None):
    """Header CSV to a DataFrame with NULL as the only missing value.

    Every cell arrives as text and null tokens become NULL; then the rest is cast
    to the schema's types. Columns the schema does not name stay text. Without a
    schema the types are inferred from the cells that are left. Column selection reaches the scan.
    """
    raw = csv_text(spark, path)
    wanted = columns or raw.columns
    kinds = infer_kinds(raw, wanted) if schema is None else {f.name: f.dataType for f in schema}

    def cell(name):
        text, kind = _present(name), kinds.get(name, T.StringType())
        if isinstance(kind, (T.IntegerType, T.LongType)):
            return whole_number(text, kind, name).alias(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return nan_to_null(text.cast("double")).alias(name)
        return text.cast(kind).alias(name)

    return raw.select([cell(name) for name in wanted])


def read_table(spark, path, columns=None):
    """A Parquet table with NULL as the only missing value."""
    df = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select([
        nan_to_null(col(c)).alias(c) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else col(c)
        for c in columns or df.columns
    ])


def write_table(df, path):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df, table, path, buckets, key=CUSTOMER):
    """A catalog table bucketed and sorted by the join key, so later joins on it need no shuffle.

    One task writes one bucket, so there are as many files as buckets.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


MANIFEST = "_stage.json"  # readers of tables pass over names with an underscore


def write_stage(df, path, version="", **measures):
    """Write a stage table with a manifest; returns the table and what was counted while it was written.

    ``measures`` are aggregates over the rows written, beside their number ``rows``. They are taken
    in the writing tasks, each of which counts once however often it is retried, so they cost no pass.
    """
    spark, seen = df.sparkSession, Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(name) for name, m in measures.items()])
    observed.write.mode("overwrite").parquet(path)
    table, counted = spark.read.parquet(path), dict(seen.get)
    facts = {"rows": counted["rows"], "schema": table.schema.simpleString(), "version": version}
    target = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, MANIFEST))
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(json.dumps(facts).encode()))
    out.close()
    return table, counted


def manifest(spark, path):
    """What is known of a stage table: rows, schema and version; None without a manifest."""
    target = os.path.join(path, MANIFEST)
    if not path_exists(spark, target):
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def load_or_compute(spark, folder, name, compute, fresh=False, version=""):
    """The finished stage table if there is one, else compute and write it.

    The manifest is written last and goes first when the stage is written anew, so a job that died
    half way is redone; so is a stage with another version, or whose files no longer hold its rows and
    columns. ``version`` separates results of different inputs and code.
    """
    path = os.path.join(folder, f"{name}-{version}" if version else name)
    known = None if fresh else manifest(spark, path)
    if known and known["version"] == version and path_exists(spark, os.path.join(path, "_SUCCESS")):
        table = spark.read.parquet(path)
        if known["schema"] == table.schema.simpleString() and known["rows"] == table.count():
            return table
    return write_stage(compute(), path, version)[0]


def fingerprint(tables):
    """A short name of how the tables are computed and from what.

    It covers their whole plans, so that a changed expression changes it, and the files
    below them with sizes and times.
    """
    digest = hashlib.sha256()
    for df in tables:
        plan = df._jdf.queryExecution().optimizedPlan().canonicalized()
        # all fields of wide operators, not the first few
        digest.update(plan.treeString(True, False, 2**31 - 1, False, False).encode())
        hadoop = df.sparkSession._jsc.hadoopConfiguration()
        for name in sorted(df.inputFiles()):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
            status = path.getFileSystem(hadoop).getFileStatus(path)
            digest.update(f"{name} {status.getLen()} {status.getModificationTime()}".encode())
    return digest.hexdigest()[:12]


def require_columns(df, names):
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise KeyError(f"columns absent from the table: {absent}")


def slim(df):
    """The published columns, after checking that all of them are there."""
    require_columns(df, SLIM_COLUMNS)
    return df.select(*[col(c) for c in SLIM_COLUMNS])


def write_csv(df, path):
    df.write.mode("overwrite").csv(path, header=True, **CSV_WHOLE_CELLS)


def export_slim(df, path):
    write_csv(slim(df), path)


def export_full(df, path, drop=("SET", CUSTOMER)):
    write_csv(df.drop(*drop), path)


def load_typed(spark, csv_path, table, path):
    """Load the slim CSV with its declared types into a catalog table, replacing an older one."""
    raw = csv_text(spark, csv_path)
    raw = raw.toDF(*[name.lower() for name in raw.columns])
    typed = raw.select([
        (whole_number(col(f.name), f.dataType, f.name) if isinstance(f.dataType, T.IntegralType)
         else col(f.name).cast(f.dataType)).alias(f.name) for f in schemas.SLIM
    ])
    typed.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def stage_view(source, name="stg_credit_data"):
    """The staging layer: a view of the slim columns over the loaded table."""
    source.select(*[col(c.lower()) for c in SLIM_COLUMNS]).createOrReplaceTempView(name)
    return source.sparkSession.table(name)
