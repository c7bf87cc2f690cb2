"""Texts that operators have to stand: empty, odd, very long, repeated."""

import random

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "and", "a", "to", "in"]) if r.random() < 0.3 else "".join(r.choices("abcdeé", k=4)) for _ in range(n))


def odd_documents():
    passage = prose(1, 60)
    return [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "one"), (5, "One"), (6, "two words"),
        (7, prose(2, 100) + " " + passage), (8, passage + "\n" + prose(3, 80)), (9, prose(4, 30) + " " + passage + " " + passage),
        (10, prose(5, 120)), (11, prose(5, 120)), (12, prose(5, 120) + " more"), (13, prose(5, 119) + " Äé x"),
        (14, "x" * 20_000), (15, prose(6, 20_000)), (16, "again " * 3000), (17, prose(7, 40).upper()),
        (18, "a  b\u00a0 c\u2003\n d\x1c e \U0001f600"), (19, "line one here\nline one here\n\nline two"), (-5, passage),
    ]


def documents(spark):
    """The smallest table's documents and the odd ones, with ids of their own."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text")
    return table.union(spark.createDataFrame(odd_documents(), DOCS))
