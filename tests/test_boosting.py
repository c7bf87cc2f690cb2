"""Boosted trees against an exhaustive search over cuts, and their ways through Spark."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from creditloom.operators import boosting
from creditloom.operators.boosting import BoostedModel, BoostedTrees, Tree, best_cuts, grow_gathered

NAMES = ["a", "b", "c", "same"]


def sample(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 12, n), rng.exponential(size=n), np.ones(n)])
    y = (x[:, 0] * (x[:, 1] > 5) + 0.3 * x[:, 2] + rng.normal(size=n) * 0.4 > 0.4).astype(float)
    return x, y, rng.uniform(0.5, 2, n)


def table(spark, x, y, w, parts=3):
    rows = [(*map(float, v), float(t), float(u)) for v, t, u in zip(x, y, w)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*NAMES, "y", "w"])).repartition(parts)
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)


def boosted(x, y, w, rounds, rate, depth, leaves, least):
    """Margins by trying every value of every feature in every node, the best leaf first."""
    margin = np.full(len(y), np.log((w * y).sum() / (w * (1 - y)).sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        nodes = [(np.arange(len(y)), 0)]

        def best(rows):
            found = None
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= v]
                    right = rows[x[rows, f] > v]
                    if min(len(left), len(right)) < least:
                        continue
                    gain = sum(g[i].sum() ** 2 / h[i].sum() * s for i, s in ((left, 1), (right, 1), (rows, -1)))
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = gain, left, right
            return found

        while len(nodes) < leaves:
            offers = [(best(rows), k) for k, (rows, d) in enumerate(nodes) if d < depth]
            offers = [(o, k) for o, k in offers if o]
            if not offers:
                break
            (_, left, right), k = max(offers, key=lambda o: o[0][0])
            d = nodes.pop(k)[1] + 1
            nodes += [(left, d), (right, d)]
        for rows, _ in nodes:
            margin[rows] -= rate * g[rows].sum() / h[rows].sum()
    return margin


@pytest.mark.parametrize("gathered", [0, 60, 10_000])
def test_trees_equal_an_exhaustive_search(spark, gathered, monkeypatch):
    """Whether nodes are cut by histograms, by one task, or both; with margins written anew in between."""
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "BLOCK_FEATURES", 2)
    x, y, w = sample(150)
    df = table(spark, x, y, w)
    model = BoostedTrees(
        labelCol="y", weightCol="w", maxIter=5, stepSize=0.3, maxDepth=4, maxLeaves=6, minRows=8, minHessian=0.0,
        gatheredRows=gathered,
    ).fit(df)
    assert model.numTrees == 5
    assert np.allclose(model.margins(x)[:, -1], boosted(x, y, w, 5, 0.3, 4, 6, 8), atol=1e-9)
    leaves = [sum(n[0] == t and n[2] < 0 for n in model.nodes) for t in range(5)]
    assert max(leaves) == 6 and max(n[1] for n in model.nodes) < 2**5


def test_many_tasks_and_small_histograms_change_nothing(spark, monkeypatch):
    x, y, w = sample(300)
    settings = dict(labelCol="y", weightCol="w", maxIter=2, maxDepth=3, gatheredRows=0)
    plain = BoostedTrees(**settings).fit(table(spark, x, y, w))
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 1)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 1)
    again = BoostedTrees(**settings).fit(table(spark, x, y, w, 7))
    assert np.allclose(plain.margins(x), again.margins(x), atol=1e-9)


def test_histogram_and_sorted_cuts_agree():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 9, (200, 3)).astype(np.uint8)
    g, h = rng.normal(size=200), rng.uniform(0.1, 1, 200)
    shape = {"bins": 9, "rows": 5, "hessian": 1.0, "l2": 1.0, "depth": 3}
    found = {c[0]: c[1:] for c in grow_gathered(codes, g, h, 1, 3, np.arange(3), shape)}
    histograms = boosting._histograms(codes, g, h, np.zeros(200, int), 1, 9)[0]
    gain, feature, at, *left = best_cuts(histograms, 5, 1.0, 1.0)
    assert found[1][1:3] == (feature, at) and np.allclose(found[1][0], gain) and np.allclose(found[1][3:6], left)
    assert best_cuts(histograms, 101, 0.0, 0.0) is None


def test_leaves_are_chosen_by_gain():
    cuts = {1: (9.0, 0, 0, 1.0, 2.0, 5.0), 2: (1.0, 0, 1, 0.5, 1.0, 2.0), 3: (2.0, 1, 0, -1.0, 1.0, 2.0), 6: (5.0, 0, 2, 0.1, 0.1, 1.0)}
    tree = Tree(cuts, (3.0, 6.0), 3, 1.0, 0.0, 4, [[0.1, 0.2, 0.3], [0.4]])
    assert [k for k in range(16) if tree.feature[k] >= 0] == [1, 3, 6]
    assert tree.value[2] == pytest.approx(-0.5) and tree.value[7] == pytest.approx(-(2.0 + 1.0) / (4.0 - 1.0))


def test_loss_falls_scores_are_stored_and_draws_repeat(spark, tmp_path):
    x, y, w = sample()
    df = table(spark, x, y, w)
    model = BoostedTrees(labelCol="y", weightCol="w", maxIter=20, maxDepth=3).fit(df)
    loss = [r.loss for r in model.staged_loss(df).orderBy("round").collect()]
    assert len(loss) == 20 and all(b < a for a, b in zip(loss, loss[1:]))
    model.write().overwrite().save(str(tmp_path / "model"))
    again = BoostedModel.load(str(tmp_path / "model"))
    scores = [[tuple(r) for r in m.transform(df).select("a", "probability", "prediction").collect()] for m in (model, again)]
    assert scores[0] == scores[1] and again.getStepSize() == 0.1
    p = {r.a: r.probability[1] for r in model.transform(df).collect()}
    assert np.allclose([p[v] for v in x[:, 0]], 1 / (1 + np.exp(-model.margins(x)[:, -1])))
    importance = model.featureImportances
    assert importance[0] == max(importance) and importance[3] == 0 and sum(importance) == pytest.approx(1)
    drawn = [BoostedTrees(
        labelCol="y", weightCol="w", maxIter=3, subsamplingRate=0.5, columnShare=0.5, seed=4).fit(df).nodes for _ in range(2)]
    assert drawn[0] == drawn[1] and len({n[2] for n in drawn[0] if n[0] == 0} - {-1}) <= 2


def test_one_value_per_feature_gives_the_share(spark):
    df = table(spark, np.ones((10, 4)), np.arange(10) % 2, np.ones(10))
    model = BoostedTrees(labelCol="y", weightCol="w", maxIter=2).fit(df)
    assert {r.probability[1] for r in model.transform(df).collect()} == {0.5}


def test_a_small_table_takes_one_job_per_tree(spark, monkeypatch):
    x, y, w = sample(6000)
    level, calls = boosting._level, []
    monkeypatch.setattr(boosting, "_level", lambda *args: calls.append(1) or level(*args))
    model = BoostedTrees(labelCol="y", weightCol="w", maxIter=3, maxDepth=4).fit(table(spark, x, y, w))
    assert model.numTrees == 3 and len(calls) == 3
    assert max(n[1] for n in model.nodes) >= 2**4


def test_nodes_of_many_rows_take_one_stage_a_level_and_the_others_one_job(spark, monkeypatch):
    """Only the smaller of two children is looked at where the parent's histograms are there."""
    x, y, w = sample(3000)
    level, sums, calls, looked = boosting._level, boosting._sums, [], []
    monkeypatch.setattr(boosting, "_level", lambda *args: calls.append(args[2]) or level(*args))
    monkeypatch.setattr(boosting, "_sums", lambda *args: looked.append(list(args[2])) or sums(*args))
    settings = dict(labelCol="y", weightCol="w", maxIter=2, maxDepth=5)
    model = BoostedTrees(**settings, gatheredRows=100).fit(table(spark, x, y, w))
    assert calls == [[], []] and looked[0] == [1] and len(looked) > 4
    assert all(k ^ 1 not in some for some in looked for k in some)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 1)
    again = BoostedTrees(**settings, gatheredRows=100).fit(table(spark, x, y, w, 5))
    assert np.allclose(model.margins(x), again.margins(x), atol=1e-9)


def test_gathered_nodes_are_shared_out_by_their_rows():
    sizes = {2 * k: 1000 - k for k in range(1, 25)}
    turn = boosting._even(sizes, 8)
    loads = [sum(sizes[k] for k in sizes if turn[k] == i) for i in range(8)]
    assert max(loads) - min(loads) < 50


def test_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    assert [boosting._tasks(n, 100, 8, 50) for n in (50, 150, 100_000, 50_000_000)] == [1, 1, 8, 104]
    pieces = spark.sparkContext.parallelize([np.zeros(n) for n in [7] * 90 + [1] * 10], 3)
    rows = boosting._dealt(pieces, 8).glom().map(lambda some: sum(map(len, some))).collect()
    assert len(rows) == 8 and max(rows) - min(rows) <= 14


def test_bin_edges_fill_bins_evenly(spark, monkeypatch):
    """Exactly the values of a plain sketch while a table is small, and close to them when only some values of a chunk go into it."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    x, y, w = sample(300)
    df = table(spark, x, y, w)
    shares = [i / 20 for i in range(1, 20)]
    plain = df.select(*[F.percentile_approx(vector_to_array("features")[i], shares, 1000) for i in range(4)]).first()
    assert boosting.bin_edges(df, "features", 4, 300, 20) == [
        sorted({c for c in cuts if c < x[:, i].max()}) for i, cuts in enumerate(plain)
    ]
    x, y, w = sample(2000)
    df = table(spark, x, y, w)
    monkeypatch.setattr(boosting, "SORTED_VALUES", 4 * 300)
    some = boosting.bin_edges(df, "features", 4, 20_000, 20)  # every twentieth value
    ranks = np.searchsorted(np.sort(x[:, 0]), some[0]) / 2000
    assert np.abs(ranks - shares).max() < 0.04 and some[3] == []


def test_rows_of_one_task_are_not_shuffled(spark, monkeypatch):
    from pyspark.core.rdd import RDD

    calls, deal = [], RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, *args: calls.append(1) or deal(self, *args))
    monkeypatch.setattr(boosting, "REFRESH", 2)
    x, y, w = sample(1000)
    model = BoostedTrees(labelCol="y", weightCol="w", maxIter=5, maxDepth=3).fit(table(spark, x, y, w))
    assert model.numTrees == 5 and not calls
