"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards. A key descends it level by level: each
child of the node reached draws ln(u) / weight, with u in (0, 1) from a hash of
the key and the child's place, and the greatest draw wins. A child is drawn with
a chance in proportion to its weight, whatever else is there, so when weights
change, keys move only into or out of the subtrees whose weights changed.

An added shard gets a region of its own: it changes no old subtree, so keys move
into it alone.
"""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch, small
from creditloom.llm.workers import map_batches

HASH_DIGITS = 13  # hexadecimal digits of a draw's hash: 52 bits, exact in a double
LEVELS = ("region", "rack", "shard")


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree: its number, its place and its weight."""

    number: int
    region: str
    rack: str
    weight: float = 1.0


def even_tree(regions, racks, shards, added=0):
    """Shards of equal weight numbered along the tree, then ``added`` ones, each in a region of its own."""
    first = [
        Shard((i * racks + j) * shards + k, str(i), str(j))
        for i in range(regions) for j in range(racks) for k in range(shards)
    ]
    return first + [Shard(len(first) + n, str(regions + n), "0") for n in range(added)]


def _children(tree):
    """{path of a node: [(name, path, weight) of its children]}; the weight of a node is that of its shards."""
    numbers = [s.number for s in tree]
    if len(set(numbers)) != len(numbers) or any(s.weight <= 0 or "/" in s.region + s.rack for s in tree):
        raise ValueError("shards need numbers of their own, weights above 0 and names without a slash")
    out = {}
    for s in tree:
        path = ""
        for name in (s.region, s.rack, str(s.number)):
            child = f"{path}/{name}"
            known = out.setdefault(path, {})
            known[name] = (child, known.get(name, (child, 0))[1] + s.weight)
            path = child
    return {parent: [(name, path, w) for name, (path, w) in found.items()] for parent, found in out.items()}


def _draw(key, path, weight):
    """ln(u) / weight of one child for one key."""
    digest = F.md5(F.concat(key, path).cast("binary"))
    number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
    return F.ln((number + 0.5) / float(16**HASH_DIGITS)) / weight


def shard_of(key, tree):
    """Column: the shard of a text ``key`` in ``tree``, by one draw per child of the three nodes on its way."""
    children = _children(tree)

    def listed(parent):
        return F.array(*[
            F.struct(F.lit(path).alias("path"), F.lit(float(w)).alias("weight")) for _, path, w in children[parent]
        ])

    def won(options):
        draws = F.transform(options, lambda c: F.struct(_draw(key, c["path"], c["weight"]).alias("draw"), c["path"]))
        return F.array_max(draws)["path"]

    path = won(listed(""))
    for depth in (1, 2):
        parents = [p for p in children if p.count("/") == depth]
        table = F.create_map(*[x for p in parents for x in (F.lit(p), listed(p))])
        path = won(table[path])
    return F.element_at(F.split(path, "/"), -1).cast("int")


def shard_documents(docs, tree, grown=None, key="doc_id", text="text"):
    """One row per document: the key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8, ``text_crc32`` its unsigned CRC-32; a NULL text has no bytes. The law is
    ``key``: the key and the tree alone decide the shard, so rows with equal keys, NULL ones too, meet in one shard.
    ``grown_shard`` is the shard in the tree ``grown``, NULL without one. Slots count the rows of a shard from 0 without
    gaps, by key (NULL first), CRC and size; rows equal in all three, such as repeated rows, take theirs in any order.
    Other columns are not read.

    Texts are read once and not shuffled. Narrow rows are ordered by ranges, in which rows of one key are split where
    they are many; a range counts its rows per shard, and the counts of earlier ranges are its offsets.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    name, content = F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    placed = scratch.keep(docs.select(
        F.col(key).alias("key"), (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), shard_of(name, tree).alias("shard"),
        (shard_of(name, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    ), "placed")
    order = ["shard", "key", "text_crc32", "size", "row"]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    counted = ranged.withColumn("part", F.spark_partition_id())
    local = scratch.keep(map_batches(
        counted, _numbered, counted.drop("place").schema.simpleString()[7:-1].replace(":", " ") + ", place bigint"
    ), "local")
    scratch.drop("placed")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.keep(local.groupBy("shard", "part").count(), "counts").select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    return local.join(small(scratch.keep(offsets, "offsets")), ["shard", "part"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("place")).alias("slot"), "grown_shard",
    )


def _numbered(batches):
    """The rows of a range, ordered by shard, with their place among those of the same shard."""
    shard, place = None, 0
    for batch in batches:
        places = []
        for s in batch.column("shard").to_pylist():
            shard, place = s, place + 1 if s == shard else 0
            places.append(place)
        yield batch.append_column("place", pa.array(places, pa.int64()))


def write_shards(docs, tree, path, key="doc_id"):
    """Write whole documents as Parquet below ``path``, one folder ``shard=N`` for each shard that has any.

    Every task writes what it read, so a shard may have several files and a hot key needs no shuffle.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    docs.withColumn("shard", shard_of(name, tree)).write.partitionBy("shard").parquet(path)
