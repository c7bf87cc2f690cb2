"""Near-duplicate documents by an LSH forest of MinHash signatures.

Each tree of the forest is one sorted order of the documents by its own part of
their signatures. Neighbours in an order with a common prefix are candidates,
so the depth to which two documents are compared adapts to how crowded their
region is: alone in a region, a short common prefix suffices; in a crowded one
the neighbours are those with the longest. Candidates are confirmed on full
shingle sets. Documents with equal sets are one node from the start.

A first round looks at next neighbours in a few orders, which connects most of
a group of copies; the second looks at several neighbours in all orders, but
only across what is not connected yet. One confirmed pair connects two
components, so pairs are confirmed in steps, the likeliest of two components
first; what its links make pairs of one component is not looked at again. The
sets compared then grow with the documents, not with the pairs of a group.

Regions with more members than the neighbours cover, and of more than one
component then, are searched exactly: their members are dealt out in blocks of
bounded size, and every pair of different components meets in one of them. The
blocks give no pairs but only edges that connect what the pairs connect. So the
scans of the orders only need the likeliest neighbour of each member there.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from creditloom.llm.components import components
from creditloom.llm.scratch import Scratch, small
from creditloom.llm.words import Words, mixed, text_slices, window_hashes
from creditloom.llm.workers import map_batches, map_groups

PARTS, DEPTH = 16, 6  # parts of a signature, and values in each
ORDERS = 2 * PARTS  # by each part, and by the second half of each with the first half of the next
LEAST_DEPTH = 2  # common values that make neighbours candidates; a pair of similarity 0.8 lacks them in all orders once in 10^7
ROUNDS = ((4, 1), (ORDERS, 8))  # orders, and neighbours on either side
LEAST_CROWDED = ROUNDS[-1][1] + 2  # members of a region that the neighbours on one side do not cover; it is searched exactly
# The steps of each round: one pair is confirmed for each value of these columns, or all that are left. A pair the
# first round leaves out is found again in the second, which has its orders and neighbours too.
STEPS = ((("a",),), (("low", "high"), ()))
ESTIMATE_SLACK = 0.25  # below the wanted similarity; five deviations of the sketch's estimate
BLOCK_NODES, BLOCK_SHINGLES = 1000, 400_000  # of each of the two sides of a block
BLOCK_COLUMNS = 2048  # shingles that are multiplied at a time
_VALUES, _KEY = PARTS * DEPTH, 4 * DEPTH
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_rng = np.random.Generator(np.random.PCG64(20240607))
_A = _rng.integers(0, 2**63, _VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, _VALUES, dtype=np.uint64)
_ONE, _TWO = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)  # fixed values: two hash families


def _shingle_sets(texts, shingle):
    """Distinct shingle hashes of a slice of documents, sorted by document and hash, and how many each has."""
    words = Words(texts)
    hashes, per_doc = words.hashes(_FOLD), words.per_doc
    value, at = window_hashes(hashes, per_doc, shingle)
    values, docs = [value], [words.doc[at]]
    for n in range(1, shingle):  # a shorter text is one shingle
        short = np.flatnonzero(per_doc == n)
        if len(short):
            first = words.first[short]
            picked = (first[:, None] + np.arange(n)).ravel()
            value, _ = window_hashes(hashes[picked], np.full(len(short), n), n)
            values.append(mixed(value + np.uint64(n)))
            docs.append(short)
    value, doc = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), np.bool_)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.bincount(doc, minlength=words.n_docs).astype(np.int64)


def _sum_by(values, starts):
    return np.add.reduceat(values, starts)


def signatures(df, shingle, doc, text):
    """Per row: doc_id, n_shingles, and of its shingle set a digest (128 bits), keys (its signature) and a sketch.

    The sketch has two bits of each signature value. A row without words has NULL for the three.
    """
    source = df.select(F.col(f"`{doc}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def signed(batches):
        for batch in batches:
            for first, texts in text_slices(pc.fill_null(batch.column(1), "")):
                value, size = _shingle_sets(texts, shingle)
                full = size > 0
                digest, keys, sketch = ([None] * len(size) for _ in range(3))
                if full.any():
                    starts = (np.cumsum(size) - size)[full]
                    sums = np.stack([_sum_by(mixed(value ^ k), starts) for k in (_ONE, _TWO)], 1).astype(">u8")
                    least = np.empty((len(starts), _VALUES), ">u4")
                    for j, (a, b) in enumerate(zip(_A, _B)):
                        least[:, j] = np.minimum.reduceat(((value * a + b) >> np.uint64(32)).astype(np.uint32), starts)
                    bits = (least[:, :, None] & np.array([1, 2], np.uint32)) > 0
                    two = np.packbits(bits.reshape(len(starts), -1), axis=1)
                    for k, i in enumerate(np.flatnonzero(full)):
                        digest[i], keys[i], sketch[i] = sums[k].tobytes(), least[k].tobytes(), two[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(size), pa.array(digest, pa.binary()),
                     pa.array(keys, pa.binary()), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "keys", "sketch"],
                )

    return map_batches(source, signed, "doc_id long, n_shingles long, digest binary, keys binary, sketch binary")


_ROW = "tree int, key binary, node long, size long, sketch binary, component long"
_FOUND = f"a long, b long, different int, part int, place long, {_ROW}"
_KINDS = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
_NAMES = ["a", "b", "different", "part", "place", "tree", "key", "node", "size", "sketch", "component"]


def _least_equal(percent):
    """Values of a sketch that are equal at least where two sets may be similar."""
    similarity = percent / 100 - ESTIMATE_SLACK
    return int(_VALUES * (similarity + (1 - similarity) / 4))  # values differ in two bits by chance too


def _neighbours(percent, near, by_part):
    """Candidate pairs among rows sorted by tree and key; with ``by_part`` also the rows at a task's ends.

    In a region seen to be crowded, each row gives its likeliest pair only: ``crowded_links`` finds the others.
    """
    least_equal = _least_equal(percent)

    def pairs(tree, key, node, size, sketch, component):
        prefix = key[:, :4 * LEAST_DEPTH].copy().view(">u8").ravel()
        starts = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1])))
        members = np.diff(np.append(starts, len(tree)))  # of the rows at hand, so at most those of the region
        crowded = np.repeat(members >= LEAST_CROWDED, members)
        out = []
        for step in range(1, near + 1):
            x, y = slice(step, None), slice(None, -step)
            low, high = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            which = np.flatnonzero(
                (tree[x] == tree[y]) & (prefix[x] == prefix[y]) & (100 * low >= percent * high)
                & (component[x] != component[y])
            )
            bits = np.unpackbits(sketch[which] ^ sketch[which + step], axis=1).reshape(len(which), _VALUES, 2)
            different = bits.any(2).sum(1)
            near_enough = _VALUES - different >= least_equal
            which, different = which[near_enough], different[near_enough]
            low, high = np.minimum(node[which], node[which + step]), np.maximum(node[which], node[which + step])
            out.append((low, high, different, which + step))
        low, high, different, row = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((high, low, different, row))
        likeliest = np.append(True, row[order][1:] != row[order][:-1])[:len(row)]
        kept = order[likeliest | ~crowded[row[order]]]
        return low[kept], high[kept], different[kept]

    def of_pairs(a, b, different):
        empty = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int64(), *_KINDS)]
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(different, pa.int32()), *empty], names=_NAMES
        )

    def of_ends(part, ends):
        none = pa.nulls(len(ends), pa.int64())
        place = pa.array(sorted(ends), pa.int64())
        rows = zip(*(ends[i] for i in sorted(ends)))
        return pa.RecordBatch.from_arrays(
            [none, none, none.cast(pa.int32()), pa.array([part] * len(ends), pa.int32()), place,
             *(pa.array(c, t) for c, t in zip(rows, _KINDS))], names=_NAMES,
        )

    def scan(batches):
        part, seen, ends, last = TaskContext.get().partitionId(), 0, {}, None
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            for i in {*range(min(n, max(0, near - seen))), *range(max(0, n - near), n)} if by_part else ():
                ends[seen + i] = [batch.column(c)[i].as_py() for c in range(6)]
            rows = tuple(
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) if _KINDS[c] == pa.binary()
                else batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)
            )
            if last:
                rows = tuple(np.concatenate([a, b]) for a, b in zip(last, rows))
            # Pairs inside the rows carried over were found before; finding them again does no harm.
            yield of_pairs(*pairs(*rows))
            seen += n
            last = tuple(c[-near:] for c in rows)
            for i in [i for i in ends if near <= i < seen - near]:
                del ends[i]
        if ends:
            yield of_ends(part, ends)

    return scan


def _in_orders(nodes, orders, length):
    """``nodes`` in each of the first ``orders`` orders, with the first ``length`` bytes of their keys there."""
    half = F.lit(_KEY // 2)
    start = F.when(F.col("t") < PARTS, F.col("t") * _KEY).otherwise((F.col("t") - PARTS) * _KEY + half)
    return nodes.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(orders - 1)))).select(
        F.col("t").alias("tree"), F.substring(F.concat("keys", "keys"), start + 1, F.lit(length)).alias("key"),
        "node", F.col("n_shingles").alias("size"), "sketch", "component",
    )


def candidates(nodes, orders, near, percent, scratch, name):
    """(a, b, different) of nodes of different components that are neighbours in one of the first ``orders`` orders.

    ``nodes``: node, n_shingles, keys, sketch, component. Each order is cut into
    ranges, so a crowded region is spread over tasks. ``different`` counts the values their sketches differ in. The few rows at the ends
    of the tasks' ranges meet those of the next range in a second scan.
    """
    rows = _in_orders(nodes, orders, _KEY)
    ordered = rows.repartitionByRange("tree", "key").sortWithinPartitions("tree", "key", "node")
    found = scratch.keep(map_batches(ordered, _neighbours(percent, near, True), _FOUND), f"{name}_neighbours")
    # As many rows as the ranges have ends: twice ``near`` for each task of the scan.
    ends = found.where("part IS NOT NULL").repartition(1).sortWithinPartitions("part", "place").select(
        "tree", "key", "node", "size", "sketch", "component"
    )
    across = map_batches(ends, _neighbours(percent, near, False), _FOUND)
    return scratch.keep(
        found.where("part IS NULL").select("a", "b", "different").union(across.select("a", "b", "different")).distinct(),
        f"{name}_candidates",
    )


def confirmed(pairs, df, shingle, doc, text, percent, scratch, name):
    """(a, b) of the pairs whose shingle sets have intersection and union in the wanted ratio.

    The sets of the nodes in the pairs are made from their texts.
    """
    wanted = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}_wanted")
    sets = scratch.keep(_sets_of(df, wanted, shingle, doc, text), f"{name}_sets")

    def similar(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = (
        pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "set_a"}), "a")
        .join(sets.withColumnsRenamed({"node": "b", "shingles": "set_b"}), "b")
    )
    # A batch holds whole sets; Arrow batches are bounded in bytes.
    return scratch.keep(
        map_batches(with_sets.select("a", "b", "set_a", "set_b"), similar, "a long, b long"), f"{name}_links"
    )


def _sets_of(df, wanted, shingle, doc, text):
    """(node, shingles) of the documents that are ``wanted`` nodes; shingles are sorted 64-bit hashes."""
    source = df.select(F.col(f"`{doc}`").cast("bigint").alias("node"), F.col(f"`{text}`").alias("text"))

    def made(batches):
        for batch in batches:
            for first, texts in text_slices(pc.fill_null(batch.column(1), "")):
                value, size = _shingle_sets(texts, shingle)
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.array([value[b - n:b].tobytes() for b, n in zip(ends, size)], pa.binary())],
                    names=["node", "shingles"],
                )

    return map_batches(source.join(small(wanted), "node", "left_semi"), made, "node long, shingles binary")


def _in_blocks(rows, group, function):
    """``function`` on blocks of ``rows`` of one group, in which every two rows of the group meet at least once.

    A group is cut into ``blocks`` chunks by a hash of the node, and each two
    chunks are one block. ``function`` has the block's columns, sorted by node,
    and gives a boolean matrix of the pairs that belong together; the result
    (a, b: long) connects what these pairs connect, with fewer edges than rows.
    """
    chunk = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("chunk", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    ).withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("other", "blocks")

    def edges(block):
        block = block.sort_by("node")
        low, high, chunk, node = (block.column(c).to_numpy() for c in ("low", "high", "chunk", "node"))
        x, y = np.flatnonzero(chunk == low[0]), np.flatnonzero(chunk == high[0])
        together = np.zeros((len(node), len(node)), np.bool_)
        together[np.ix_(x, y)] = function(block, x, y)
        together |= together.T
        left, a, b = together.any(1), [], []
        for first in range(len(node)):
            if not left[first]:
                continue
            left[first], found = False, np.array([first])
            while len(found):
                found = np.flatnonzero(together[found].any(0) & left)
                left[found] = False
                a.append(np.full(len(found), node[first])), b.append(node[found])
        return pa.table({"a": np.concatenate([*a, np.zeros(0, np.int64)]), "b": np.concatenate([*b, np.zeros(0, np.int64)])})

    return map_groups(dealt, [*group, "low", "high"], edges, "a long, b long")


def _similar_sketches(percent):
    """Pairs of a block, of different components, whose sketches and sizes allow the wanted similarity."""
    most_different = _VALUES - _least_equal(percent)

    def similar(block, x, y):
        sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint64).reshape(len(block), -1)
        size, component = block.column("size").to_numpy(), block.column("component").to_numpy()
        different = np.zeros((len(x), len(y)), np.int64)
        for word in sketch.T:
            bits = word[x][:, None] ^ word[y][None, :]
            different += np.bitwise_count((bits | bits >> np.uint64(1)) & np.uint64(0x5555555555555555))
        low, high = np.minimum.outer(size[x], size[y]), np.maximum.outer(size[x], size[y])
        return (
            (different <= most_different) & (100 * low >= percent * high) & (component[x][:, None] != component[y][None, :])
        )

    return similar


def _similar_sets(percent):
    """Pairs of a block, of different components, whose shingle sets have intersection and union in the wanted ratio."""

    def similar(block, x, y):
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in block.column("shingles").combine_chunks()]
        component = block.column("component").to_numpy()
        size = np.array([len(s) for s in sets])
        _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        sides = []
        for side in (x, y):
            place = np.full(len(sets), -1)
            place[side] = np.arange(len(side))
            of_side = place[row] >= 0
            sides.append((place[row[of_side]], shingle[of_side]))
        both = np.intersect1d(sides[0][1], sides[1][1])
        shared = np.zeros((len(x), len(y)), np.int64)
        columns = []
        for place, shingles in sides:
            at = np.searchsorted(both, shingles)
            at[at == len(both)] = 0
            known = both[at] == shingles if len(both) else np.zeros(len(at), np.bool_)
            order = np.argsort(at[known], kind="stable")
            columns.append((place[known][order], at[known][order]))
        for first in range(0, len(both), BLOCK_COLUMNS):
            dense = []
            for side, (place, at) in zip((x, y), columns):
                part = slice(*np.searchsorted(at, [first, first + BLOCK_COLUMNS]))
                matrix = np.zeros((len(side), min(BLOCK_COLUMNS, len(both) - first)), np.float32)
                matrix[place[part], at[part] - first] = 1
                dense.append(matrix)
            shared += (dense[0] @ dense[1].T).astype(np.int64)
        union = np.add.outer(size[x], size[y]) - shared
        return (shared > 0) & (100 * shared >= percent * union) & (component[x][:, None] != component[y][None, :])

    return similar


def crowded_links(nodes, df, shingle, doc, text, percent, scratch):
    """(a, b) that connect all similar nodes that share a crowded region and are not connected yet; None without any.

    ``nodes``: node, n_shingles, keys, sketch, component. A region (first values
    of an order) of no more nodes than the neighbours on one side has had all
    its pairs compared. In a larger one, of more than one component, sketches
    are compared in blocks; what they connect is one family. All pairs of a
    family are then compared by their full sets, in blocks again.
    """
    regions = _in_orders(nodes, ORDERS, 4 * LEAST_DEPTH)
    crowded = scratch.keep(
        regions.groupBy("tree", "key").agg(
            F.count("*").alias("n"), F.min("component").alias("first"), F.max("component").alias("last")
        ).where(f"n >= {LEAST_CROWDED} AND first < last").select(
            "tree", "key", F.ceil(F.col("n") / BLOCK_NODES).alias("blocks")
        ), "crowded",
    )
    if crowded.isEmpty():
        return None
    alike = _in_blocks(regions.join(small(crowded), ["tree", "key"]), ["tree", "key"], _similar_sketches(percent))
    alike = scratch.keep(alike.distinct(), "crowded_alike")
    families = components(alike, scratch, "crowded_components").withColumnRenamed("component", "family")
    families = scratch.keep(families, "crowded_families")
    named = nodes.groupBy("node").agg(F.min("component").alias("component"))
    sets = _sets_of(df, families.select("node"), shingle, doc, text).where("length(shingles) > 0")
    sets = scratch.keep(sets.join(families, "node").join(named, "node"), "crowded_sets")
    blocks = scratch.keep(sets.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum(F.length("shingles")) / (8 * BLOCK_SHINGLES))
    ).alias("blocks")), "crowded_blocks")
    links = _in_blocks(sets.join(small(blocks), "family"), ["family"], _similar_sets(percent))
    return scratch.keep(links.distinct(), "crowded_links")


def _chosen(pairs, labels, tested, by):
    """Of the pairs of different components that were not ``tested``: the one with the likest sketches per ``by``, or all."""
    for end, component in (("a", "component_a"), ("b", "component_b")):
        named = labels.select(F.col("node").alias(end), F.col("component").alias(component))
        pairs = pairs.join(named, end, "left").withColumn(component, F.coalesce(component, end))
    pairs = pairs.where("component_a <> component_b").withColumns({
        "low": F.least("component_a", "component_b"), "high": F.greatest("component_a", "component_b")
    })
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    if not by:
        return pairs.select("a", "b")
    return pairs.groupBy(*by).agg(F.min(F.struct("different", "a", "b")).alias("pair")).select("pair.a", "pair.b")


def near_duplicates(df, shingle=5, percent=80, doc="doc_id", text="text", name="near_duplicates"):
    """Per row of ``df``: doc_id, n_shingles (long), component_id (long) and kept.

    Texts are lower-cased in A-Z and cut into words ``[^\\x20\\x09-\\x0D]+``. A
    document's set holds its distinct shingles of ``shingle`` words; a text of
    fewer words is one shingle; without words (or NULL) the set is empty and
    linked with nothing. Two documents are linked if their sets' intersection is
    at least ``percent`` of their union. component_id is the smallest doc_id
    reachable over links, the document itself included; kept marks that one.

    Rows that share a doc_id are one document with several texts, linked by any
    of them. A row with a NULL doc_id is linked with nothing: its component_id
    is NULL and it is kept. Other columns are ignored; no row is dropped.

    Links are confirmed on full sets of 64-bit shingle hashes. A pair of
    similarity 0.8 has no common prefix in any order about once in 10^7. Regions
    more crowded than the neighbours looked at are searched exactly.
    """
    scratch = Scratch(df.sparkSession, name)
    signed = scratch.keep(signatures(df, shingle, doc, text), "signatures")
    # Equal sets are one node, named by its smallest document.
    nodes = scratch.keep(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("keys").alias("keys"),
            F.any_value("sketch").alias("sketch"),
        ), "nodes",
    )
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    rows = scratch.keep(
        rows.join(nodes.select("digest", "node"), "digest", "left").select(
            "doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node")
        ), "rows",
    )
    # Rows with one doc_id and different texts: all their nodes are linked.
    several = rows.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    same_id = rows.join(several, "doc_id").select(F.col("low").alias("a"), F.col("node").alias("b")).where("a <> b")

    links = scratch.keep(same_id, "same_id")
    labels = df.sparkSession.createDataFrame([], "node long, component long")

    def named():
        return nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    for i, (orders, near) in enumerate(ROUNDS):
        pairs, tested = candidates(named(), orders, near, percent, scratch, f"round{i}"), None
        for k, by in enumerate(STEPS[i]):
            step = f"round{i}_step{k}"
            chosen = scratch.keep(_chosen(pairs, labels, tested, by), f"{step}_pairs")
            if i and chosen.isEmpty():
                break
            links = links.union(confirmed(chosen, df, shingle, doc, text, percent, scratch, step))
            tested = chosen if tested is None else tested.union(chosen)
            labels = scratch.keep(components(links, scratch, f"{step}_components"), f"{step}_labels")
    more = crowded_links(scratch.keep(named(), "named"), df, shingle, doc, text, percent, scratch)
    if more is not None:
        labels = scratch.keep(components(links.union(more), scratch, "crowded_all"), "crowded_labels")
    return rows.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"),
        F.coalesce(F.coalesce("component", "node") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
