"""Sharding against a plain descent of the tree, and the laws of the tree."""

import collections
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from creditloom.llm import queries, shards
from creditloom.llm.shards import Shard, even_tree
from fixtures import DOCS, FOLDER, documents


def descend(key, tree):
    """The shard of a key, by sums and draws over the tree's levels."""
    levels = [lambda s: "/" + s.region, lambda s: f"/{s.region}/{s.rack}", lambda s: f"/{s.region}/{s.rack}/{s.number}"]
    for level in levels:
        weights = collections.defaultdict(float)
        for s in tree:
            weights[level(s)] += s.weight

        def draw(path):
            h = int(hashlib.md5((key + path).encode()).hexdigest()[:13], 16)
            return math.log((h + 0.5) / 2**52) / weights[path]

        best = max(weights, key=draw)
        tree = [s for s in tree if level(s) == best]
    return tree[0].number


def test_documents(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.collect()] + [(None, "a"), (None, None), (5, "One"), (5, "One")] + [(77, "same")] * 400
    table = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS shard", "1 AS size", "2 AS part", "3 AS place")
    tree, grown = even_tree(3, 2, 4), even_tree(3, 2, 4, added=1)
    got = shards.shard_documents(table.repartition(7), tree, grown).collect()
    wanted, at = collections.Counter(), {}
    for doc, text in rows:
        key, data = "" if doc is None else str(doc), (text or "").encode()
        at.setdefault(key, (descend(key, tree), descend(key, grown)))
        wanted[doc, len(data) + 8, zlib.crc32(data), "key", *at[key]] += 1
    assert wanted == collections.Counter(
        (r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]))
    for found in slots.values():
        assert [s[0] for s in sorted(found)] == list(range(len(found)))
        assert [s[1:] for s in sorted(found)] == sorted(s[1:] for s in found)


def shards_of(spark, tree, n=20_000):
    keys = spark.range(n).select(F.col("id").cast("string").alias("key"))
    return {r.key: r.shard for r in keys.select("key", shards.shard_of(F.col("key"), tree).alias("shard")).collect()}


@pytest.mark.parametrize("added", [0, 1, 5])
def test_an_added_shard_takes_keys_only_into_itself(spark, added):
    before, after = (shards_of(spark, even_tree(3, 2, 4, added + n)) for n in (0, 1))
    moved = {k for k in before if before[k] != after[k]}
    assert {after[k] for k in moved} == {24 + added}
    share = len(moved) / len(before) * (25 + added)
    assert 0.85 < share < 1.15


def test_keys_follow_weights_and_move_within_changed_subtrees(spark):
    tree = [Shard(0, "a", "x", 1), Shard(1, "a", "x", 3), Shard(2, "a", "y", 4), Shard(3, "b", "x", 2), Shard(4, "b", "x", 6)]
    before = shards_of(spark, tree)
    share = collections.Counter(before.values())
    for s in tree:
        assert abs(share[s.number] / len(before) - s.weight / 16) < 0.02
    # Weight moves between two shards of one rack: keys outside it stay.
    after = shards_of(spark, [Shard(0, "a", "x", 2), Shard(1, "a", "x", 2), *tree[2:]])
    assert {(before[k], after[k]) for k in before if before[k] != after[k]} == {(1, 0)}
    # A rack gets heavier: nothing moves between other racks or out of it.
    after = shards_of(spark, [Shard(0, "a", "x", 5), *tree[1:]])
    assert all(after[k] in (0, 1) or before[k] == after[k] or before[k] in (3, 4) and after[k] == 2
               for k in before) and all(after[k] in (0, 1) for k in before if before[k] in (0, 1))


def test_bad_trees_are_refused(spark):
    for tree in ([Shard(0, "a", "x"), Shard(0, "b", "x")], [Shard(0, "a", "x", 0)], [Shard(0, "a/b", "x")]):
        with pytest.raises(ValueError):
            shards.shard_of(F.col("key"), tree)


def test_no_rows(spark):
    assert not shards.shard_documents(spark.createDataFrame([], DOCS), even_tree(1, 1, 2)).count()


def test_query_and_files(spark, tmp_path):
    df = queries.op12_shard_documents(spark, FOLDER)
    assert dict(df.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    }
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    shards.write_shards(docs, even_tree(3, 2, 4), str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in stored.collect()} == {(r.doc_id, r.shard) for r in df.collect()}
