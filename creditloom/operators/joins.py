"""Left joins onto a spine that keep every spine row exactly once."""

from pyspark.sql import functions as F

from creditloom.settings import CUSTOMER, LABEL, SET


def left_join_unique(spine, tables, key):
    """Left-join tables that are unique on ``key``, one after the other.

    Tables summarised by the key are already partitioned by it, so the joins add
    one shuffle for the spine and none for the tables. Spine rows without a key
    match nothing; they are added after the joins instead of meeting in one
    task. A key with very many spine rows is left to adaptive execution, which
    splits it. Building the plan runs no job.
    """
    joined = _left_joins(spine.where(F.col(key).isNotNull()), tables, key)
    return joined.unionByName(spine.where(F.col(key).isNull()), allowMissingColumns=True)


def _left_joins(spine, tables, key):
    for table in tables:
        spine = spine.join(table, key, "left")
    return spine


def union_sets(train, test):
    """Labelled and unlabelled applications in one table, tagged by set, label NULL for the second."""
    tagged = test.withColumns({SET: F.lit("test"), LABEL: F.lit(None).cast("double")})
    return train.withColumns({SET: F.lit("train"), LABEL: F.col(LABEL).cast("double")}).unionByName(
        tagged, allowMissingColumns=True
    )


def customer_view(applications, summaries):
    """One row per application with the features of all summaries, in the given order."""
    return left_join_unique(applications, summaries, CUSTOMER)


def key_profile(df, name, key=CUSTOMER):
    """Rows, distinct keys and duplicated keys of a table that should be unique on ``key``."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
    ).select(F.lit(name).alias("table_name"), "*")


def check_unique(tables, key=CUSTOMER):
    """Fail before a join that would multiply rows, naming the tables at fault."""
    profiles = [key_profile(df, name, key) for name, df in tables.items()]
    union = profiles[0]
    for profile in profiles[1:]:
        union = union.unionByName(profile)
    at_fault = union.where(F.col("duplicated_keys") > 0).collect()
    if at_fault:
        raise RuntimeError(
            "join would multiply rows, duplicate keys in: "
            + ", ".join(f"{row.table_name} ({row.duplicated_keys})" for row in at_fault)
        )


def check_row_count(expected, actual):
    if expected != actual:
        raise RuntimeError(f"join changed the row count: expected {expected}, got {actual}")
