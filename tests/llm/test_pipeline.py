"""The pipeline stage by stage against plain loops, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import brute
import corpus_pipeline
from compare import connect, differences
from creditloom.llm import quality, queries
from fixtures import prose
from test_operators import check_packing, star_family

FOLDER = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]

    good = stages["quality_rules"](spark, docs, FOLDER)
    kept = {r.doc_id for r in quality.judge_quality(docs).where("kept").collect()}
    assert {d for d, _ in pairs(good)} == kept and good.columns == docs.columns

    single = stages["near_dedup"](spark, good, FOLDER)
    groups = brute.near_duplicates(pairs(good), 5)
    assert sorted(pairs(single)) == sorted((d, t) for d, t in pairs(good) if groups[d][1] == d)

    cut = stages["substring_dedup"](spark, single, FOLDER)
    wanted = brute.repeated_passages(pairs(single), corpus_pipeline.PASSAGE_WORDS)
    assert {d: brute.words(t) for d, t in pairs(cut)} == {d: w for d, (_, _, w) in wanted.items()}
    assert cut.where("n_chars <> length(text)").isEmpty() and cut.columns == docs.columns

    clean = stages["decontamination"](spark, cut, FOLDER)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hits = brute.overlaps(pairs(cut), items)
    assert {d for d, _ in pairs(clean)} == {d for d, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}

    packed = stages["best_fit_packing"](spark, clean, FOLDER).collect()
    used, least = check_packing(packed, pairs(clean), 2048)
    assert used <= least + 1
    whole = corpus_pipeline.run(spark, FOLDER)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in whole.collect()) == sorted(tuple(r[k] for k in key) for r in packed)


def test_one_document_of_a_star_of_many_copies_stays(spark):
    data = star_family(700, 250, 5)
    groups = brute.near_duplicates(data, 5)
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    single = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, FOLDER)
    assert sorted(pairs(single)) == [(d, t) for d, t in data if groups[d][1] == d] == data[:1]


def test_stages_on_odd_rows(spark):
    """Nulls, repeated rows and columns named like the results of operators."""
    text = prose(1, 80)
    data = [(1, text, "a", 7, "x", 1), (1, text, "a", 7, "x", 1), (2, None, None, None, None, None), (3, "", "b", 1, "y", 0)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, q_source string, n_words int, kept string, n_hit int")
    stages = dict(corpus_pipeline.STAGES)
    stay = {"quality_rules": data[:2], "near_dedup": data, "decontamination": data}
    for name, wanted in stay.items():
        out = stages[name](spark, docs, FOLDER)
        assert out.columns == docs.columns and sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str), name
    cut = stages["substring_dedup"](spark, docs, FOLDER)
    assert cut.columns == docs.columns and cut.count() == len(data)
    assert sorted(map(str, ((r.q_source, r.n_words, r.kept) for r in cut.collect()))) == sorted(str(r[2:5]) for r in data)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) == ""


def test_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())


def test_native_queries_run_no_python(spark):
    for name in ("op1_quality_rules", "op6_decontaminate"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


def test_labels_agree_with_quality(spark):
    """Held-out labels: clean documents stay, most junk goes."""
    folder = "/root/testdata/sf0.01"
    judged = queries.op1_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    shares = {r.quality: r.share for r in judged.where("NOT base_failed OR quality = 0").groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("share")).collect()}
    assert shares[1] > 0.99 and shares[0] < 0.05
