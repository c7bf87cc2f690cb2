"""Exact quantiles against a sorted list, with settings that force every kind of round."""

import math
import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators import quantiles as Q
from creditloom.operators.quantiles import quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def expected(values, share):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    at = (len(values) - 1) * share
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def frames():
    rnd = random.Random(5)
    return {
        "tail": [rnd.lognormvariate(0, 4) for _ in range(3000)],
        "hot": [0.0 if i % 3 else rnd.gauss(0, 1) for i in range(3000)],
        "two": [float(i % 2) for i in range(3000)],
        "constant": [4.0] * 3000,
        "missing": [rnd.random() if i % 5 == 0 else None for i in range(3000)],
        "nothing": [None] * 3000,
        "negative": [-(1.5 ** rnd.randint(0, 60)) for _ in range(3000)],
        "single": [3.0] + [None] * 2999,
    }


@pytest.mark.parametrize("settings", [
    {}, {"CUTS": 10, "MARGIN": 1, "COUNTED": 200}, {"CUTS": 20, "ACCURACY": 5, "MARGIN": 0, "COUNTED": 10},
])
def test_quantiles_match_sorting(spark, settings, monkeypatch):
    """With one pass over few values, with several sketches, and with sketches that are off."""
    for name, value in settings.items():
        monkeypatch.setattr(Q, name, value)
    data = frames()
    names = list(data)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{n} double" for n in names)).repartition(5)
    found = quantiles(df, {n: F.col(n) for n in names}, SHARES)
    for n in names:
        assert found[n] == [expected(data[n], s) for s in SHARES], n


def test_whole_numbers_and_expressions(spark):
    df = spark.range(1001)
    found = quantiles(df, {"id": F.col("id"), "twice": F.col("id") * 2}, [0.5])
    assert found == {"id": [500.0], "twice": [1000.0]}


def test_infinite_values_are_refused(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,)], "x double")
    with pytest.raises(ValueError, match="x"):
        quantiles(df, {"x": F.col("x")}, [0.5])


def test_passes_follow_the_rows_not_the_values(spark, monkeypatch):
    """A sketch and a count, whether values are spread over one or over six hundred orders of magnitude."""
    passes = []
    for name in ("_sketched", "_narrowed"):
        step = getattr(Q, name)
        monkeypatch.setattr(Q, name, lambda *args, step=step, name=name: passes.append(name) or step(*args))
    df = spark.range(20_000).select(
        (F.hash("id") / 2**31).alias("flat"), F.pow(F.lit(10.0), F.hash("id") / 2**31 * 300).alias("steep")
    )
    for name in df.columns:
        passes.clear()
        values = sorted(r[0] for r in df.select(name).collect())
        assert quantiles(df, {name: F.col(name)}, SHARES)[name] == [expected(values, s) for s in SHARES]
        assert passes == ["_sketched", "_narrowed"]


def test_a_pass_sends_counts_and_drawn_values_out_of_the_tasks(spark, monkeypatch):
    """Not a row per value, with several chunks a task."""
    monkeypatch.setattr(Q, "CHUNK", 4000)
    monkeypatch.setattr(Q, "DRAWN", 1000)
    sent, chunks = [], Q._sorted_chunks
    monkeypatch.setattr(Q, "_sorted_chunks", lambda *args: sent.append(chunks(*args).count()) or chunks(*args))
    df = spark.range(20_000).select((F.hash("id") / 2**31).alias("x"), (F.hash(-F.col("id")) / 2**31).alias("y")).repartition(3)
    found = quantiles(df, {name: F.col(name) for name in df.columns}, [0.5])
    for at, name in enumerate(df.columns):
        assert found[name] == [expected([r[at] for r in df.collect()], 0.5)]
    assert len(sent) >= 2 and max(sent) < 10_000
