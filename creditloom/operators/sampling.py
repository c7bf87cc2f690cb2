"""Repeatable splits and samples by a hash of the key.

A row's place depends only on its key and the seed, never on partitioning, so a
retried task puts it where it was. Exact shares come from exact ranks of the hash:
a count per hash prefix finds the prefix holding the wanted rank, and only the
rows of that prefix are ranked.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.functions.scalar import col
from creditloom.session import small_table

PREFIX_BITS = 16


HASH_BITS = 60


def key_hash(key, seed=S.SEED):
    """The first 60 bits of the MD5 of ``seed:key``, which any engine can compute; a missing key counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_cuts(df, key, ranks, group=None, seed=S.SEED, prefix_bits=PREFIX_BITS):
    """The hash at the given ranks (1-based) of each group: {group: [hash, ...]}.

    ``ranks`` maps a group's value to its wanted ranks; ``group`` is a column
    with few values (a class label), or nothing for the table as one group.
    Returned facts are as many as ``ranks`` holds.
    """
    member = F.lit(0) if group is None else F.col(group).cast("int")
    hashed = df.select(member.alias("g"), key_hash(key, seed).alias("h")).withColumn(
        "prefix", F.shiftright("h", HASH_BITS - prefix_bits)
    )
    per_group = Window.partitionBy("g").orderBy("prefix")
    # at most 2 ** prefix_bits rows per group
    counted = hashed.groupBy("g", "prefix").agg(F.count("*").alias("n")).withColumn(
        "upto", F.sum("n").over(per_group)
    )
    wanted = small_table(
        df.sparkSession, [(g, rank) for g, some in ranks.items() for rank in some if rank > 0], "g int, rank long"
    )
    targets = counted.join(F.broadcast(wanted), "g").where(
        (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
    ).select("g", "prefix", "rank", (F.col("rank") - F.col("upto") + F.col("n")).alias("place"))
    narrow = targets.select("g", "prefix").distinct()
    # rows with the same key merge before they are ranked
    values = hashed.join(F.broadcast(narrow), ["g", "prefix"]).groupBy("g", "prefix", "h").agg(
        F.count("*").alias("m")
    ).withColumn("last", F.sum("m").over(Window.partitionBy("g", "prefix").orderBy("h")))
    found = values.join(F.broadcast(targets), ["g", "prefix"]).where(
        (F.col("place") <= F.col("last")) & (F.col("place") > F.col("last") - F.col("m"))
    ).select("g", "rank", "h").collect()
    cuts = {(row.g, row["rank"]): row.h for row in found}
    return {g: [cuts.get((g, rank)) for rank in some] for g, some in ranks.items()}


def _below(hash_column, cut):
    return F.lit(False) if cut is None else hash_column <= F.lit(cut)


def split_column(df, key=S.CUSTOMER, label=S.LABEL, share=S.HOLDOUT_SHARE, seed=S.SEED):
    """Condition that is true for the held-out rows: the exact share of each class, rounded."""
    sizes = {r.g: r.n for r in df.groupBy(F.col(label).cast("int").alias("g")).agg(F.count("*").alias("n")).collect()}
    ranks = {g: [int(n * share + 0.5)] for g, n in sizes.items()}
    cuts = hash_cuts(df, key, ranks, label, seed)
    chain = F.lit(False)
    for g, (cut,) in cuts.items():
        chain = F.when(F.col(label).cast("int") == g, _below(key_hash(key, seed), cut)).otherwise(chain)
    return chain


def stratified_split(df, key=S.CUSTOMER, label=S.LABEL, share=S.HOLDOUT_SHARE, seed=S.SEED):
    """Training and held-out rows with the same class shares."""
    held_out = split_column(df, key, label, share, seed)
    return df.where(~held_out), df.where(held_out)


def fold_column(df, key=S.CUSTOMER, label=S.LABEL, folds=S.CV_FOLDS, seed=S.SEED + 1):
    """Fold number of each row; every fold holds the same share of each class."""
    sizes = {r.g: r.n for r in df.groupBy(F.col(label).cast("int").alias("g")).agg(F.count("*").alias("n")).collect()}
    ranks = {g: [n * i // folds for i in range(1, folds)] for g, n in sizes.items()}
    cuts = hash_cuts(df, key, ranks, label, seed)
    h = key_hash(key, seed)
    fold = F.lit(None).cast("int")
    for g, some in cuts.items():
        above = sum((F.when(_below(h, cut), 0).otherwise(1) for cut in some), F.lit(0))
        fold = F.when(F.col(label).cast("int") == g, above).otherwise(fold)
    return fold


def sample_rows(df, n=S.CV_SAMPLE_ROWS, key=S.CUSTOMER, seed=S.SEED):
    """Exactly min(n, rows) rows, the same ones on every run, without sorting the table."""
    rows = df.count()
    if rows <= n:
        return df
    (cut,) = hash_cuts(df, key, {0: [n]}, seed=seed)[0]
    return df.where(_below(key_hash(key, seed), cut))


def slice_sets(df, tag=S.SET, key=S.CUSTOMER, label=S.LABEL):
    """Labelled rows with a whole-number label, and unlabelled rows without one; the key stays."""
    train = df.where(F.col(tag) == "train").drop(tag).withColumn(label, F.col(label).cast("int"))
    test = df.where(F.col(tag) == "test").drop(tag, label)
    return train, test
