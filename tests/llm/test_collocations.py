"""Collocations against plain loops, on odd texts and on the test table."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from creditloom.llm import collocations as C
from creditloom.llm import queries
from brute import LOWER
from fixtures import FOLDER, documents

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def wanted(rows, longest=3, least=10, most=2000):
    """Result rows for (lang, text) rows."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(" ".join(w[i:i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if a >= least and " " in p}
        found = []
        for p, a in candidates.items():
            if any(f" {p} " in f" {q} " and q != p and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            w = p.split(" ")
            cuts = [(count[" ".join(w[:k])], count[" ".join(w[k:])]) for k in range(1, len(w))]
            score, k = min((1_000_000 * a * a // (l * r), k) for k, (l, r) in enumerate(cuts))
            found.append((-score, -a, p.encode(), *cuts[k]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:most], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert df.columns == COLUMNS and len(set(rows)) == len(rows)
    return set(rows)


ODD = [
    (None, None), ("en", None), ("", ""), ("en", " \t \n"), (None, "new york new york. new york"),
    ("en", "New York, new york; NEW YORK! É é é"), ("en", "x"), ("long", "w " * 30_000), ("long", "y" * 50_000),
    ("en", "a b c a b c a b\x0bc a b c\x00 d"), ("d\te", "a b c d. a b c d"), ("\U0001f600", "a b c\ra b c"),
]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_odd_texts(spark, monkeypatch, longest):
    monkeypatch.setattr(C, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(C, "SLICE_BYTES", 30_000)
    monkeypatch.setattr(C, "MERGE_ENTRIES", 50)
    rows = ODD * 6
    table = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS bucket", "3 AS n")
    assert result(C.collocations(table.repartition(3), most_words=longest, least=6)) == wanted(rows, longest, 6)


def test_documents(spark):
    table = documents(spark).selectExpr("text", "CASE WHEN doc_id % 3 = 0 THEN 'x' END AS lang", "doc_id AS rank")
    rows = [(r.lang, r.text) for r in table.collect()]
    assert result(C.collocations(table, most=50)) == wanted(rows, most=50)


def test_query(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    df = queries.op13_phrase_collocations(spark, FOLDER)
    assert result(df) == wanted(rows)
    assert dict(df.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}


def test_no_rows(spark):
    assert not C.collocations(spark.createDataFrame([], "lang string, text string")).count()


def test_scores_are_exact_beyond_64_bits(spark):
    found = spark.range(1).selectExpr("CAST(1000000 AS DECIMAL(7,0)) * CAST(299999999999999 AS DECIMAL(15,0)) * "
                                      "CAST(299999999999999 AS DECIMAL(15,0)) AS over",
                                      "CAST(300000000000001 AS DECIMAL(15,0)) * CAST(300000000000007 AS DECIMAL(15,0)) AS under")
    a = 299_999_999_999_999
    assert found.selectExpr("over div under AS s").first().s == 10**6 * a * a // ((a + 2) * (a + 8))


def test_filter_knows_all_that_were_added(spark):
    rows = [("en", f"p{i}" + " q" * (i % 2), f"n{i}") for i in range(3000)]
    table = pa.table(list(map(pa.array, zip(*rows))), names=["lang", "prefix", "next"])
    hashes = C._table_hashes(*(table[c].combine_chunks() for c in table.column_names))
    filter_ = C.Filter.of(spark.createDataFrame(rows, "lang string, prefix string, next string"))
    assert filter_.has(hashes).all()
    assert filter_.has(C.mixed(np.arange(100_000, dtype=np.uint64))).mean() < 0.01


def test_hashes_of_tables_and_texts_agree():
    words, code, _, _ = C.words_of(pa.array(["Big old tree"]))
    h, lang = C._hashes(words), C._hashes(pa.array(["en"]))
    from_text = C._phrase_hashes(lang, [h[code[k:k + 1]] for k in range(3)])
    assert from_text == C._table_hashes(pa.array(["en"]), pa.array(["big old"]), pa.array(["tree"]))
