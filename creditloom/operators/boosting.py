"""Gradient boosted trees with a limit of leaves, over features that are binned once.

A round fits one tree to the gradients of the logistic loss. For every node of a
level, tasks add the gradients of their rows into a histogram per feature. Up to
a fixed size the driver adds these up; beyond, the histograms of a node and a block of
features are summed in one task, which returns the block's best cut. Nodes
with few rows send these in the end, and one task grows all below a node, with the same
sums and cuts, so a table of few rows takes one job a tree. Cuts of a node depend on its own rows alone, so the whole tree
down to the depth is cut first and the leaves are then chosen best-first.
"""

import heapq
import json
import math
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize, HasWeightCol
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import functions as F

from creditloom.operators.columns import stacked
from creditloom.session import find_package, fresh_path, small_table

BLOCK_FEATURES = 16  # whose histograms of a node are summed in one task
GATHERED_ROWS = 65536  # a node with at most so many rows is grown on by one task
HISTOGRAM_BYTES = 64 << 20  # of a task, or of all tasks together for the driver; a level with more nodes takes more passes
DIRECT_TASKS = 64  # above so many, histograms are summed in two steps
LEAST_ROWS = 20_000  # of a task; with fewer, sending histograms costs more than adding them up
TASK_BYTES = 64 << 20  # of a task's rows, about
PIECE_ROWS = 2048  # of the pieces in which rows are dealt to tasks
REFRESH = 25  # rounds after which the rows are written anew with their margins; between, each round keeps them
BINS = 255  # at most, for each feature
SORTED_VALUES = 4_000_000  # of all features together that a task sorts at a time
ROOT = 1  # the children of node i are 2 i and 2 i + 1


# Cuts

def _gain(g, h, l2):
    return g * g / (h + l2)


def best_cuts(histograms, least_rows, least_hessian, l2):
    """(gain, feature, bin, g, h, n of the left side) of the best cut of one node; None without any.

    ``histograms``: features x bins x (g, h, n). A cut puts the bins up to the named one to the left. Of equal
    gains the first feature counts, then the first bin.
    """
    left = np.cumsum(histograms, axis=1)[:, :-1]
    if not left.size:
        return None
    total = histograms[:1].sum(axis=1, keepdims=True)
    if total[0, 0, 2] < 2 * max(least_rows, 1):
        return None
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (_gain(left[..., 0], left[..., 1], l2) + _gain(right[..., 0], right[..., 1], l2)
                - _gain(total[..., 0], total[..., 1], l2))
    fits = np.minimum(left[..., 2], right[..., 2]) >= max(least_rows, 1)
    fits &= np.minimum(left[..., 1], right[..., 1]) >= least_hessian
    gain = np.where(fits & (gain > 1e-12), gain, -np.inf)
    feature, at = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[feature, at] == -np.inf:
        return None
    return float(gain[feature, at]), int(feature), int(at), *map(float, left[feature, at])


def _histograms(codes, g, h, node, n_nodes, bins, some=None):
    """nodes x features x bins x (g, h, n) of rows with their node's index.

    g, h and node have the rows in ``some``, or every one. Codes are read feature by feature, so they had better lie so.
    """
    out = np.empty((n_nodes, codes.shape[1], bins, 3))
    start = None if n_nodes == 1 else np.asarray(node, np.int64) * bins
    for f, column in enumerate(codes.T):
        spot = (column if some is None else column[some]).astype(np.int64)
        if start is not None:
            spot += start
        for k, weights in enumerate((g, h, None)):
            out[:, f, :, k] = np.bincount(spot, weights, n_nodes * bins).reshape(n_nodes, bins)
    return out


def grow_gathered(codes, g, h, root, depth, features, shape):
    """Cuts (node, gain, feature, bin, left and whole sums) of all nodes at and below ``root``.

    The histograms of the larger child are those of its parent less those of the smaller one.
    """
    codes, bins = codes.T[features].T, shape["bins"]

    def sums_of(rows):
        return _histograms(codes, g[rows], h[rows], None, 1, bins, rows if len(rows) < len(g) else None)[0]

    every = np.arange(len(g))
    out, open_ = [], [(root, every, sums_of(every))]
    while open_:
        node, rows, sums = open_.pop()
        best = best_cuts(sums, shape["rows"], shape["hessian"], shape["l2"])
        if best is None:
            continue
        gain, f, at, *left = best
        out.append((node, gain, int(features[f]), at, *left, *map(float, sums[0].sum(axis=0))))
        if node.bit_length() < depth:
            right = codes[rows, f] > at
            children = sorted(((2 * node, rows[~right]), (2 * node + 1, rows[right])), key=lambda c: len(c[1]))
            less = sums_of(children[0][1])
            rest = sums - less
            rest[rest[..., 2] == 0] = 0  # nothing is left of bins without rows
            open_ += [(*children[1], rest), (*children[0], less)]
    return out


# Trees as arrays over node numbers

def _walked(codes, feature, upto):
    """The node each row ends in: one without a cut feature (-1)."""
    node = np.full(len(codes), ROOT)
    open_ = [(ROOT, None)]
    while open_:
        k, rows = open_.pop()
        if feature[k] < 0:
            if rows is not None:
                node[rows] = k
            continue
        column = codes[:, feature[k]]
        right = (column if rows is None else column[rows]) > upto[k]
        rows = (np.flatnonzero(~right), np.flatnonzero(right)) if rows is None else (rows[~right], rows[right])
        open_ += [(2 * k + side, some) for side, some in enumerate(rows) if len(some)]
    return node


class Tree:
    """Per node: the cut feature (-1: a leaf), bin, threshold and gain, and the value of a leaf."""

    def __init__(self, cuts, totals, depth, rate, l2, leaves, thresholds):
        size = 2 ** (depth + 1)
        self.feature = np.full(size, -1, np.int32)
        self.bin, self.gain, self.value = np.zeros(size, np.int32), np.zeros(size), np.zeros(size)
        self.threshold = np.zeros(size)
        sums, open_ = {ROOT: totals}, []
        if ROOT in cuts:
            heapq.heappush(open_, (-cuts[ROOT][0], ROOT))
        n = 1
        while open_ and (leaves is None or n < leaves):
            _, k = heapq.heappop(open_)
            gain, feature, at, gl, hl, _ = cuts[k]
            self.feature[k], self.bin[k], self.gain[k], self.threshold[k] = feature, at, gain, thresholds[feature][at]
            g, h = sums.pop(k)
            sums[2 * k], sums[2 * k + 1] = (gl, hl), (g - gl, h - hl)
            n += 1
            for child in (2 * k, 2 * k + 1):
                if child in cuts:
                    heapq.heappush(open_, (-cuts[child][0], child))
        for k, (g, h) in sums.items():
            self.value[k] = -rate * g / (h + l2) if h + l2 else 0.0

    def leaves_of(self, codes, upto):
        """The node each row ends in; ``upto`` holds the codes or thresholds that rows are compared with."""
        return _walked(codes, self.feature, upto)

    def rows(self, number):
        """The tree's nodes as table rows."""
        live, out = [ROOT], []
        while live:
            k = live.pop()
            leaf = self.feature[k] < 0
            out.append((number, k, int(self.feature[k]), float(self.threshold[k]), float(self.gain[k]), float(self.value[k])))
            live += [] if leaf else [2 * k, 2 * k + 1]
        return out


_NODES = "tree int, node int, feature int, threshold double, gain double, value double"


# Rows

def _unpacked(block):
    """A stored piece of the rows as numpy columns: row, y, weight, margin, and features x rows of codes."""
    y = np.frombuffer(block.y)
    codes = np.frombuffer(block.codes, np.uint8).reshape(-1, len(y))
    return np.frombuffer(block.row, np.int64), y, np.frombuffer(block.weight), np.frombuffer(block.margin), codes


def _dealt(pieces, tasks):
    """The pieces in ``tasks`` partitions, none with many more rows than another."""
    if tasks > 1:
        pieces = pieces.zipWithIndex().map(lambda item: (item[1], item[0])).partitionBy(tasks, int).values()
    return pieces.coalesce(tasks)


def _whole(pieces):
    """The pieces of a task as one: row, y, weight, margin, codes (rows x features, feature by feature in memory)."""
    *columns, codes = zip(*pieces)
    return *map(np.concatenate, columns), np.concatenate(codes, axis=1).T


def _tasks(n_rows, n_features, cores, gathered):
    """Partitions of the rows to boost on: whole rounds of the cores, or as many as the rows are worth."""
    if n_rows <= max(gathered, LEAST_ROWS):
        return 1
    rounds = -(-n_rows * (n_features + 32) // (cores * TASK_BYTES))
    return max(1, min(cores * rounds, n_rows // LEAST_ROWS))


def _renewed(rows, tree):
    """The pieces with the margins after one more tree."""
    def added(pieces):
        pieces = list(pieces)
        if pieces:
            margin, codes = _whole([piece[3:] for piece in pieces])
            margin = margin + tree.value[tree.leaves_of(codes, tree.bin)]
            ends = np.cumsum([len(piece[0]) for piece in pieces])
            for (row, y, weight, old, some), end in zip(pieces, ends):
                yield row, y, weight, margin[end - len(old):end], some

    return rows.mapPartitions(added)


def _gradients(margin, y, weight):
    p = 1 / (1 + np.exp(-margin))
    return weight * (p - y), weight * p * (1 - p)


def _drawn(rows, seed, share):
    """Which rows take part in a round, by a hash of their numbers."""
    if share >= 1:
        return np.ones(len(rows), bool)
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD6E8FEB86659FD93 % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.float64) < share * 2.0**53


_BLOCKS = "row binary, y binary, weight binary, margin binary, codes binary"
_Cut = namedtuple("_Cut", "node gain feature bin gl hl nl g h n")


def _placed(cuts, seed, shape):
    """A function that gives a task's rows with the node of each in a growing tree: (codes, g, h, node).

    ``cuts``: those of the tree so far. A row that takes no part in the round is in node 0, which no tree has.
    """
    size = 2 ** (shape["depth"] + 1)
    path, upto = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    for k, cut in cuts.items():
        path[k], upto[k] = cut[1], cut[2]

    def placed(pieces):
        row, y, weight, margin, codes = _whole(pieces)
        g, h = _gradients(margin, y, weight)
        node = _walked(codes, path, upto)
        if shape["row_share"] < 1:
            node[~_drawn(row, seed, shape["row_share"])] = 0
        return codes, g, h, node

    return placed


def _sums_of(codes, g, h, node, nodes, features, shape):
    """Histograms of the rows in ``nodes``; None where there are none."""
    part = np.full(2 ** (shape["depth"] + 1), -1)
    part[nodes] = np.arange(len(nodes))
    live = np.flatnonzero(part[node] >= 0)
    if len(live):
        some = live if len(live) < len(g) else None
        codes = codes if len(features) == codes.shape[1] else codes.T[features].T
        return _histograms(codes, g[live], h[live], part[node[live]], len(nodes), shape["bins"], some)


def _sums(rows, cuts, nodes, seed, features, shape):
    """node -> features x bins x (g, h, n) of all rows, added up by the driver; only for few nodes and tasks."""
    placed = _placed(cuts, seed, shape)

    def summed(pieces):
        pieces = list(pieces)
        found = _sums_of(*placed(pieces), nodes, features, shape) if pieces else None
        if found is not None:
            yield found

    total = np.zeros((len(nodes), len(features), shape["bins"], 3))
    for found in rows.mapPartitions(summed).collect():
        total += found
    return dict(zip(nodes, total))


def _even(sizes, tasks):
    """node -> one of ``tasks``, so that these get about as many rows each."""
    heap, out = [(0, i) for i in range(tasks)], {}
    for k in sorted(sizes, key=lambda k: (-sizes[k], k)):
        n, i = heapq.heappop(heap)
        out[k] = i
        heapq.heappush(heap, (n + sizes[k], i))
    return out


def _level(rows, cuts, pending, gathered, seed, features, shape):
    """Best cuts of the ``pending`` nodes, and of everything below those in ``gathered``; None for a node without.

    ``cuts``: those of the tree that grows. ``gathered``: node -> rows.
    """
    bins, depth = shape["bins"], shape["depth"]
    sent = np.zeros(2 ** (depth + 1), bool)
    sent[list(gathered)] = True
    blocks = [features[i:i + BLOCK_FEATURES] for i in range(0, len(features), BLOCK_FEATURES)]
    placed = _placed(cuts, seed, shape)

    def shared(index, rows):
        pieces, slot = list(rows), index % shape["slots"]
        if pieces:
            codes, g, h, node = placed(pieces)
            sums = _sums_of(codes, g, h, node, pending, features, shape) if pending else None
            for k in np.unique(node[sent[node]]):
                mine = np.flatnonzero(node == k)
                yield (int(k), -1, slot), (codes.T[:, mine], g[mine], h[mine])
            if sums is not None:
                for i, k in enumerate(pending):
                    for b in range(len(blocks)):
                        yield (k, b, slot), sums[i][b * BLOCK_FEATURES:(b + 1) * BLOCK_FEATURES]

    def summed(items):
        total = {}
        for key, data in items:
            if key[1] < 0:
                yield key, data
            else:
                total[key] = total[key] + data if key in total else data
        yield from total.items()

    def cut(items):
        pieces, total = {}, {}
        for (node, block, _), data in items:
            if block < 0:
                pieces.setdefault(node, []).append(data)
            else:
                total[node, block] = total[node, block] + data if (node, block) in total else data
        while pieces:
            node, some = pieces.popitem()
            codes, g, h = zip(*some)
            codes, g, h = np.concatenate(codes, axis=1), np.concatenate(g), np.concatenate(h)
            found = grow_gathered(codes.T, g, h, node, depth, features, shape)
            if not found or found[0][0] != node:
                yield _uncut(node, float(g.sum()), float(h.sum()), float(len(g)))
            yield from found
        for (node, block), sums in total.items():
            yield _cut_of(node, sums, blocks[block], shape)

    tasks = max(1, min(rows.context.defaultParallelism, len(pending) * len(blocks) + len(gathered)))
    turn = {(k, b): i % tasks for i, (k, b) in enumerate((k, b) for k in pending for b in range(len(blocks)))}
    turn.update(((k, -1), i) for k, i in _even(gathered, tasks).items())
    found, slots = rows.mapPartitionsWithIndex(shared), shape["slots"]
    if slots > 1:
        # So many tasks that one node's histograms should not all meet at once.
        found = found.partitionBy(tasks * slots, lambda key: turn[key[:2]] * slots + key[2]).mapPartitions(summed)
    if shape["tasks"] > 1:
        found = found.partitionBy(tasks, lambda key: turn[key[:2]])
    best = {}
    # A few numbers for each node and block of features.
    for item in found.mapPartitions(cut).collect():
        item = _Cut(*item)
        if item.node not in best or (-item.gain, item.feature) < (-best[item.node].gain, best[item.node].feature):
            best[item.node] = item
    return best


def _uncut(node, *whole):
    return (node, -np.inf, -1, -1, 0.0, 0.0, 0.0, *whole)


def _cut_of(node, sums, features, shape):
    """The best cut of a node by its histograms over ``features``, as a row."""
    best, whole = best_cuts(sums, shape["rows"], shape["hessian"], shape["l2"]), tuple(map(float, sums[0].sum(axis=0)))
    return (node, best[0], int(features[best[1]]), best[2], *best[3:], *whole) if best else _uncut(node, *whole)


def _fit_tree(rows, n_rows, seed, features, shape, thresholds):
    """One more tree, or None where no node can be cut.

    Nodes of many rows are cut level by level. While the histograms of all tasks are small, the driver adds them up and has
    those of the larger child from its parent's less the smaller one's; else they are summed in tasks.
    Nodes of few rows are left to one last job, which grows all below them.
    """
    cuts, totals, gathered, known = {}, None, {}, {}
    width = 24 * len(features) * shape["bins"]
    pending, sizes = [ROOT], {ROOT: n_rows}

    def noted(best):
        nonlocal totals
        for k, row in best.items():
            if k == ROOT and totals is None:
                totals = row.g, row.h
            if row.feature >= 0:
                cuts[k] = row.gain, row.feature, row.bin, row.gl, row.hl, row.nl

    while pending:
        gathered.update((k, sizes[k]) for k in pending if sizes[k] <= shape["gathered"])
        shared = [k for k in pending if k not in gathered]
        # the smaller one of two children stands for both where their parent's histograms are there
        looked = sorted({min(k, k ^ 1, key=lambda c: (sizes[c], c)) if k >> 1 in known else k for k in shared})
        best = {}
        if not shared:
            known = {}
        elif len(looked) * width * shape["tasks"] <= HISTOGRAM_BYTES:
            found = _sums(rows, cuts, looked, seed, features, shape)
            for k in shared:
                if k not in found:
                    found[k] = known[k >> 1] - found[k ^ 1]
                    found[k][found[k][..., 2] == 0] = 0  # nothing is left of bins without rows
            known = {k: found[k] for k in shared}
            best = {k: _Cut(*_cut_of(k, sums, features, shape)) for k, sums in known.items()}
        else:
            room, known = max(1, HISTOGRAM_BYTES // width), {}
            for i in range(0, len(shared), room):
                best.update(_level(rows, cuts, shared[i:i + room], {}, seed, features, shape))
        noted(best)
        pending = []
        for k, row in best.items():
            if row.feature >= 0 and k.bit_length() < shape["depth"]:
                sizes[2 * k], sizes[2 * k + 1] = row.nl, row.n - row.nl
                pending += [2 * k, 2 * k + 1]
    if gathered:
        noted(_level(rows, cuts, [], gathered, seed, features, shape))
    if totals is None:
        return None
    return Tree(cuts, totals, shape["depth"], shape["rate"], shape["l2"], shape["leaves"], thresholds)


def bin_edges(df, features, n_features, n_rows, bins=BINS):
    """Ascending values per feature that close its bins, all but the last: about equally filled ones, distinct values.

    Tasks sort chunks of rows and give every so many-th value of a feature, from a drawn place on; a sketch is made of these.
    """
    shares, accuracy = [i / bins for i in range(1, bins)], 50 * bins
    step, held = max(1, n_rows // accuracy), max(1, SORTED_VALUES // n_features)

    def drawn(values, rng):
        values = np.sort(values, axis=0)
        for i, x in enumerate(values.T):
            some = x[int(rng.integers(step))::step]
            # the chunk's greatest value comes along, in a row of its own
            yield np.full(len(some) + 1, i), np.append(some, np.nan), np.append(np.full(len(some), np.nan), x[-1])

    def given(chunk, rng):
        parts = list(drawn(np.concatenate(chunk), rng))
        i, x, high = (np.concatenate(c) for c in zip(*parts))
        last = np.isnan(x) & ~np.isnan(high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(x, mask=last), pa.array(high, mask=~last)], names=["i", "x", "high"]
        )

    def sketched(batches):
        rng, chunk, n = np.random.default_rng(TaskContext.get().partitionId()), [], 0
        for batch in batches:
            if len(batch):
                chunk.append(batch.column("x").flatten().to_numpy().reshape(len(batch), -1))
                n += len(batch)
            if n >= held:
                yield from given(chunk, rng)
                chunk, n = [], 0
        if chunk:
            yield from given(chunk, rng)

    values = df.select(vector_to_array(features).alias("x")).mapInArrow(sketched, "i int, x double, high double")
    found = values.groupBy("i").agg(F.percentile_approx("x", shares, accuracy).alias("cuts"), F.max("high").alias("high"))
    edges = {row.i: sorted({c for c in row.cuts or () if c < row.high}) for row in found.collect()}
    return [edges.get(i, []) for i in range(n_features)]


def _binned(df, features, label, weight, edges, start):
    """The rows to boost on in pieces: numbered, with one byte per feature and a margin."""
    uppers = [np.array(e) for e in edges]

    def coded(batches):
        for batch in batches:
            values = batch.column("x").flatten().to_numpy().reshape(len(batch), len(uppers))
            codes = np.stack([np.searchsorted(e, values[:, f], "left").astype(np.uint8) for f, e in enumerate(uppers)])
            columns = [batch.column(c).to_numpy() for c in ("row", "y", "weight")] + [np.full(len(batch), start)]
            pieces = [slice(i, i + PIECE_ROWS) for i in range(0, len(batch), PIECE_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[some].tobytes() for some in pieces], pa.binary()) for c in columns]
                + [pa.array([codes[:, some].tobytes() for some in pieces], pa.binary())],
                names=["row", "y", "weight", "margin", "codes"],
            )

    return df.select(
        F.monotonically_increasing_id().alias("row"), F.col(label).cast("double").alias("y"),
        F.col(weight).cast("double").alias("weight"), vector_to_array(features).alias("x"),
    ).mapInArrow(coded, _BLOCKS)


def boost(df, features, label, weight, shape, rounds, seed, column_share):
    """(start margin, trees) of a boosted model; see ``BoostedTrees`` for the parameters."""
    spark = df.sparkSession
    find_package(spark)
    n_features = df.select(F.size(vector_to_array(features))).first()[0]
    sums = df.agg(
        F.count("*").alias("n"), F.sum(F.col(weight) * F.col(label)).alias("positive"), F.sum(weight).alias("all")
    ).first()
    start = float(np.log(sums.positive / (sums.all - sums.positive)))
    edges = bin_edges(df, features, n_features, sums.n, shape["max_bins"])
    shape = {**shape, "features": n_features, "bins": 1 + max(map(len, edges))}
    folder = fresh_path(spark, "boosting")
    _binned(df, features, label, weight, edges, start).write.parquet(f"{folder}/rows")
    tasks = _tasks(sums.n, n_features, spark.sparkContext.defaultParallelism, shape["gathered"])
    pieces = spark.read.schema(_BLOCKS).parquet(f"{folder}/rows").rdd.map(_unpacked)
    rows = _dealt(pieces, tasks).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    shape |= {"tasks": tasks, "slots": 1 if tasks <= DIRECT_TASKS else math.isqrt(tasks)}
    trees, before = [], None
    draw = np.random.default_rng(seed)
    for number in range(rounds):
        some = max(1, round(column_share * n_features))
        chosen = np.sort(draw.choice(n_features, some, replace=False)) if some < n_features else np.arange(n_features)
        tree = _fit_tree(rows, sums.n, seed + number, chosen, shape, edges)
        if before is not None:
            before.unpersist()  # the rows of this round are there by now
        if tree is None:
            break
        trees.append(tree)
        if number + 1 < rounds:
            before, rows = rows, _renewed(rows, tree)
            if len(trees) % REFRESH == 0:
                rows.saveAsPickleFile(f"{folder}/rows_{len(trees)}")
                # a file of many blocks would be read in as many partitions
                rows = spark.sparkContext.pickleFile(f"{folder}/rows_{len(trees)}").coalesce(tasks)
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    rows.unpersist()
    return start, trees


# Spark ML estimator and model

class _Shape(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed, HasMaxIter, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth of a tree", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "most leaves of a tree; 0: as many as the depth allows", TypeConverters.toInt)
    regLambda = Param(Params._dummy(), "regLambda", "added to the hessian of a leaf", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "least rows of a leaf", TypeConverters.toInt)
    minHessian = Param(Params._dummy(), "minHessian", "least hessian of a leaf", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows drawn per tree", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of the features drawn per tree", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature, at most 255", TypeConverters.toInt)
    gatheredRows = Param(Params._dummy(), "gatheredRows", "nodes of so many rows are grown on by one task", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(
            featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, maxDepth=6, maxLeaves=0, regLambda=0.0,
            minRows=1, minHessian=1e-3, subsamplingRate=1.0, columnShare=1.0, maxBins=BINS, gatheredRows=GATHERED_ROWS,
            seed=0,
        )


class BoostedTrees(Estimator, _Shape, DefaultParamsReadable, DefaultParamsWritable):
    """Boosting of the logistic loss by Newton steps. Features must be present, labels 0 and 1, weights positive.

    Rows and, for a leaf limit, columns are drawn per tree. Rows with equal features may fall to either side of a draw.
    """

    @keyword_only
    def __init__(self, *, featuresCol=None, labelCol=None, weightCol=None, seed=None, maxIter=None, stepSize=None,
                 maxDepth=None, maxLeaves=None, regLambda=None, minRows=None, minHessian=None, subsamplingRate=None,
                 columnShare=None, maxBins=None, gatheredRows=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        get = self.getOrDefault
        if not 2 <= get("maxBins") <= BINS:
            raise ValueError(f"maxBins must be from 2 to {BINS}")
        shape = {
            "depth": get("maxDepth"), "leaves": get("maxLeaves") or None, "rate": get("stepSize"), "l2": get("regLambda"),
            "rows": get("minRows"), "hessian": get("minHessian"), "row_share": get("subsamplingRate"),
            "max_bins": get("maxBins"), "gathered": get("gatheredRows"),
        }
        start, trees = boost(
            dataset, get("featuresCol"), get("labelCol"), get("weightCol"), shape, get("maxIter"), get("seed"),
            get("columnShare"),
        )
        n_features = dataset.select(F.size(vector_to_array(get("featuresCol")))).first()[0]
        nodes = [row for i, tree in enumerate(trees) for row in tree.rows(i)]
        return self._copyValues(BoostedModel(start, nodes, n_features))


class BoostedModel(Model, _Shape, MLReadable, MLWritable):
    """Trees as rows (tree, node, feature, threshold, gain, value); feature -1 marks a leaf."""

    def __init__(self, start=0.0, nodes=(), n_features=0):
        super().__init__()
        self.start, self.nodes, self.numFeatures = start, list(nodes), n_features
        self.numTrees = 1 + max((n[0] for n in self.nodes), default=-1)
        self._walked = None

    def _arrays(self):
        """feature, threshold and value as trees x nodes, for walking all rows down one tree at a time."""
        if self._walked is None:
            size = 1 + max((n[1] for n in self.nodes), default=1)
            feature = np.full((self.numTrees, size), -1, np.int32)
            threshold, value = np.zeros((self.numTrees, size)), np.zeros((self.numTrees, size))
            for tree, node, f, t, _, v in self.nodes:
                feature[tree, node], threshold[tree, node], value[tree, node] = f, t, v
            self._walked = feature, threshold, value
        return self._walked

    def node_table(self, spark):
        return small_table(spark, self.nodes, _NODES)

    @property
    def featureImportances(self):
        """Sum of the gains of each feature's cuts, scaled to sum to 1."""
        from pyspark.ml.linalg import DenseVector

        gains = np.zeros(self.numFeatures)
        for _, _, feature, _, gain, _ in self.nodes:
            if feature >= 0:
                gains[feature] += gain
        return DenseVector(gains / gains.sum() if gains.sum() else gains)

    def margins(self, values):
        """Margins of rows of features (numpy), one column per round."""
        feature, threshold, value = self._arrays()
        out, rows = np.empty((len(values), self.numTrees)), np.arange(len(values))
        margin = np.full(len(values), self.start)
        for t in range(self.numTrees):
            node = np.full(len(values), ROOT)
            while True:
                f = feature[t][node]
                inner = f >= 0
                if not inner.any():
                    break
                node = np.where(inner, 2 * node + (values[rows, np.maximum(f, 0)] > threshold[t][node]), node)
            margin = margin + value[t][node]
            out[:, t] = margin
        return out

    def _transform(self, dataset):
        find_package(dataset.sparkSession)
        at_start, trees = self.start, self.numTrees

        @F.pandas_udf("double")
        def probability(values):
            import pandas as pd

            x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, self.numFeatures))
            margin = self.margins(x)[:, -1] if trees else np.full(len(x), at_start)
            return pd.Series(1 / (1 + np.exp(-margin)))

        p = F.col("_p")
        return dataset.withColumn("_p", probability(vector_to_array(self.getOrDefault("featuresCol")))).withColumns({
            "probability": array_to_vector(F.array(1 - p, p)), "prediction": F.when(p > 0.5, 1.0).otherwise(0.0),
        }).drop("_p")

    def staged_loss(self, dataset):
        """(round, loss): the weighted mean logistic loss of ``dataset`` after each round, in one pass."""
        find_package(dataset.sparkSession)
        label, weight = self.getOrDefault("labelCol"), self.getOrDefault("weightCol")

        def losses(batches):
            total, all_weight = np.zeros(self.numTrees), 0.0
            for batch in batches:
                if len(batch):
                    x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
                    sign = 1 - 2 * batch.column("y").to_numpy()
                    w = batch.column("w").to_numpy()
                    total += w @ np.logaddexp(0, sign[:, None] * self.margins(x))
                    all_weight += w.sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1, self.numTrees + 1)), pa.array(total), pa.array(np.full(self.numTrees, all_weight))],
                names=["round", "loss", "weight"],
            )

        return dataset.select(
            vector_to_array(self.getOrDefault("featuresCol")).alias("x"), F.col(label).cast("double").alias("y"),
            F.col(weight).cast("double").alias("w"),
        ).mapInArrow(losses, "round bigint, loss double, weight double").groupBy("round").agg(
            (F.sum("loss") / F.sum("weight")).alias("loss")
        )

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        facts = {"start": self.model.start, "features": self.model.numFeatures}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"facts": json.dumps(facts)})
        self.model.node_table(self.sparkSession).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        facts = json.loads(metadata["facts"])
        # a model's nodes, which the driver also held when it was fitted
        nodes = [tuple(r) for r in self.sparkSession.read.schema(_NODES).parquet(f"{path}/nodes").collect()]
        model = BoostedModel(facts["start"], sorted(nodes), facts["features"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
