"""Stage tables, typed load and bucketed tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import session, settings
from creditloom.sources import files


def test_load_or_compute(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(len(calls))

    read = lambda **kw: files.load_or_compute(spark, str(tmp_path), "stage", compute, **kw).count()
    assert (read(), read(), len(calls)) == (1, 1, 1)
    assert read(fresh=True) == 2
    assert read(version="other") == 3
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert read() == 4


def test_stages_of_other_code_or_with_lost_files_are_redone(spark, tmp_path):
    wide = [(F.col("id") + i).alias(f"c{i}") for i in range(60)]
    base = spark.range(10).select("id", *wide)
    first, again = files.fingerprint([base.withColumn("x", F.lit(1))]), files.fingerprint([base.withColumn("x", F.lit(1))])
    assert first == again != files.fingerprint([base.withColumn("x", F.lit(2))])
    # a change in the last of many columns counts as well
    assert files.fingerprint([base.agg(*[F.sum(f"c{i}") for i in range(60)])]) != files.fingerprint(
        [base.agg(*[F.sum(f"c{i}") for i in range(59)], F.max("c59"))])
    path = tmp_path / "stage"
    read = lambda df, version="": files.load_or_compute(spark, str(tmp_path), "stage", lambda: df, version=version)
    read(base.repartition(4))
    assert files.manifest(spark, str(path))["rows"] == 10
    next(p for p in path.glob("part-*.parquet")).unlink()
    spark.catalog.refreshByPath(str(path))
    assert read(base.repartition(2)).count() == 10
    spark.range(10).write.mode("append").parquet(str(path))
    assert read(base).count() == 10 and files.manifest(spark, str(path))["schema"].startswith("struct<id:bigint,c0")
    assert files.manifest(spark, str(tmp_path / "none")) is None


def test_counts_are_taken_while_writing(spark, tmp_path):
    df = spark.range(100, numPartitions=5).withColumn("x", F.when(F.col("id") % 3 > 0, 1))
    table, counted = files.write_stage(df, str(tmp_path / "t"), missing=F.count_if(F.col("x").isNull()))
    assert counted == {"rows": 100, "missing": 34} and table.count() == 100


def test_slim_round_trip(spark, tmp_path):
    df = spark.range(3).select(*[
        F.when(F.col("id") > 0, F.col("id") * 365).cast("int" if c == "DAYS_BIRTH" else "double").alias(c)
        for c in settings.SLIM_COLUMNS
    ])
    files.export_slim(df, str(tmp_path / "csv"))
    loaded = files.load_typed(spark, str(tmp_path / "csv"), "slim_round_trip", str(tmp_path / "table"))
    assert dict(loaded.dtypes)["days_birth"] == "int" and dict(loaded.dtypes)["target"] == "double"
    assert sorted(r.target for r in loaded.where("target IS NOT NULL").collect()) == [365.0, 730.0]
    again = files.load_typed(spark, str(tmp_path / "csv"), "slim_round_trip", str(tmp_path / "table2"))
    assert again.count() == 3
    assert files.stage_view(again, "slim_view").columns == [c.lower() for c in settings.SLIM_COLUMNS]
    spark.sql("DROP TABLE slim_round_trip")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    left = spark.range(100).select(F.col("id").alias("SK_ID_CURR"), F.lit(1).alias("a"))
    right = spark.range(100).select(F.col("id").alias("SK_ID_CURR"), F.lit(2).alias("b"))
    one = files.write_bucketed(left, "bucketed_left", str(tmp_path / "l"), 4)
    two = files.write_bucketed(right, "bucketed_right", str(tmp_path / "r"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = one.join(two, "SK_ID_CURR")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert folder == (named.rstrip("/") if named else folder)
    assert session.fresh_path(spark, "x").startswith(folder) and session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_shuffles_start_fine_enough(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, [spark.range(10)]) == 8
        assert session.size_shuffles(spark, [spark.range(10**6)], target_bytes=10**5) == 80
        assert spark.conf.get(key) == "80"
        assert session.size_shuffles(spark, [spark.range(10**12)], most=5000) == 5000
    finally:
        spark.conf.unset(key)


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "cells.csv"
    lines = ["n,i,text,flag,day,empty"]
    lines += [f'{v},{i},"a ""b"", c",{"True" if i else "False"},2020-01-0{i + 1},' for i, v in enumerate(["1", "N/A", "2.5", "-1.#IND"])]
    path.write_text("\n".join(lines) + "\n")
    df = files.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"n": "double", "i": "int", "text": "string", "flag": "boolean", "day": "string", "empty": "double"}
    found = df.orderBy("i").collect()
    assert [r.n for r in found] == [1.0, None, 2.5, None]
    assert found[0].text == 'a "b", c' and found[0].day == "2020-01-01" and found[1].flag is True
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception, match="fraction in the whole-number column n"):
        files.read_csv(spark, str(path), schema, ["n"]).collect()
    files.write_csv(df, str(tmp_path / "again"))
    assert files.read_csv(spark, str(tmp_path / "again")).orderBy("i").collect() == found


def test_parquet_inputs_have_null_for_nan(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, x double").write.parquet(str(tmp_path / "t"))
    assert {r.k: r.x for r in files.read_table(spark, str(tmp_path / "t")).collect()} == {1: None, 2: 1.0}


def test_line_breaks_inside_quoted_cells(spark, tmp_path):
    data = [(i, f"plain {i}", i / 4) for i in range(40)]
    odd = [(100, "a\nb", 2.5), (101, 'say "x",\n\n"y"\n', 0.5), (102, "one\n,\ntwo", None), (103, None, 1.0)]
    schema = "k int, note string, x double"
    path = str(tmp_path / "cells")
    files.write_csv(spark.createDataFrame(data, schema).coalesce(2), path)
    before = files.csv_text(spark, path)
    assert before.count() == len(data) and "multiLine" not in str(before._jdf.queryExecution().analyzed())
    spark.createDataFrame(odd, schema).coalesce(1).write.mode("append").csv(path, header=True, **files.CSV_WHOLE_CELLS)
    for kinds in (None, spark.createDataFrame([], schema).schema):
        out = files.read_csv(spark, path, kinds)
        assert sorted(map(tuple, out.collect())) == data + odd
        assert out.where("k >= 100").count() == 4 and out.select("x").count() == 44


def test_only_files_with_spanning_records_are_parsed_whole(spark, tmp_path):
    for name, body in (("a", "k,note\n1,x\n2,y\n"), ("b", 'k,note\n3,"p\nq"\n')):
        (tmp_path / f"{name}.csv").write_text(body)
    out = files.csv_text(spark, str(tmp_path))
    seen = out.select("k", "note", F.spark_partition_id().alias("part")).collect()
    assert {(r.k, r.note) for r in seen} == {("1", "x"), ("2", "y"), ("3", "p\nq")}
    assert len({r.part for r in seen if r.k != "3"} & {r.part for r in seen if r.k == "3"}) == 0
