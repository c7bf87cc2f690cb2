"""Splits and samples are exact, disjoint and independent of partitioning."""

from pyspark.sql import functions as F

from creditloom.operators import sampling


def population(spark, n=5000, parts=4):
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("SK_ID_CURR"), F.when(F.col("id") % 12 == 0, 1).otherwise(0).alias("TARGET")
    )


def keys(df):
    return {r.SK_ID_CURR for r in df.collect()}


def test_hash_cuts_are_exact_ranks(spark):
    df = population(spark)
    hashes = sorted(r[0] for r in df.select(sampling.key_hash("SK_ID_CURR")).collect())
    for bits in (2, 8, 16):
        assert sampling.hash_cuts(df, "SK_ID_CURR", {0: [1, 17, 5000]}, prefix_bits=bits) == {
            0: [hashes[0], hashes[16], hashes[4999]]
        }


def test_split_has_exact_shares_per_class(spark):
    df = population(spark)
    train, held_out = sampling.stratified_split(df)
    assert keys(train) | keys(held_out) == set(range(5000)) and not keys(train) & keys(held_out)
    sizes = {r.TARGET: r["count"] for r in held_out.groupBy("TARGET").count().collect()}
    assert sizes == {1: int(417 * 0.2 + 0.5), 0: int(4583 * 0.2 + 0.5)}


def test_split_does_not_depend_on_partitioning(spark):
    one = keys(sampling.stratified_split(population(spark, parts=1))[1])
    many = keys(sampling.stratified_split(population(spark, parts=16).orderBy(F.desc("SK_ID_CURR")))[1])
    other = keys(sampling.stratified_split(population(spark), seed=1)[1])
    assert one == many and one != other


def test_folds_share_each_class(spark):
    df = population(spark)
    counts = df.withColumn("f", sampling.fold_column(df)).groupBy("TARGET", "f").count().collect()
    assert {r.f for r in counts} == set(range(5))
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r.TARGET == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_sample_size_is_exact(spark):
    df = population(spark)
    assert len(keys(sampling.sample_rows(df, 700))) == 700
    assert sampling.sample_rows(df, 5000) is df
    assert keys(sampling.sample_rows(df, 700)) == keys(sampling.sample_rows(df.repartition(9), 700))


def test_slices(rows):
    df = rows("SK_ID_CURR long, SET string, TARGET double, x int", (1, "train", 1.0, 5), (2, "test", None, 6))
    train, test = sampling.slice_sets(df)
    assert [tuple(r) for r in train.collect()] == [(1, 1, 5)] and train.columns == ["SK_ID_CURR", "TARGET", "x"]
    assert [tuple(r) for r in test.collect()] == [(2, 6)]


def test_repeated_keys_stay_together(spark):
    df = population(spark).union(population(spark).where("SK_ID_CURR < 2000"))
    hashes = sorted(r[0] for r in df.select(sampling.key_hash("SK_ID_CURR")).collect())
    assert sampling.hash_cuts(df, "SK_ID_CURR", {0: [3000, 7000]}) == {0: [hashes[2999], hashes[6999]]}
