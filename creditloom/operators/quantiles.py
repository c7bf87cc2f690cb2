"""Exact quantiles of many columns without sorting and without unbounded buffers.

A quantile of n values interpolates between the values of two neighbouring
ranks. A sketch of about equally filled cuts brackets the wanted rank; the next
pass counts the values below, at the ends of, within and above the bracket, so
it is known exactly which of these holds the rank, and sketches them anew. Once a
bracket holds few values, they are counted one by one. Each pass leaves a fixed
share of the values whatever they are, so passes follow the logarithm of the
rows, and a value held by very many rows ends a search. In a pass, tasks sort chunks of
Arrow columns and give counts and drawn values, which a grouped aggregate combines; the driver
sees a row per search.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.operators.columns import number_facts
from creditloom.session import small_table

CUTS = 500  # of a sketch
ACCURACY = 2000  # of a sketch: ranks are off by one in so many
MARGIN = 3  # cuts on either side of a rank's own; more than the sketch can be off
COUNTED = 20_000  # values that are counted one by one, for each search, about
DRAWN = 20_000  # values that a sketch is made of, about, whatever it is a sketch of
CHUNK = 4_000_000  # values of all columns together that a task sorts at a time


@dataclass(frozen=True)
class _Search:
    """The values with a rank (from 0) and the next rank among the values of column i in [low, high].

    ``size`` is their number, ``after`` the smallest value above them, ``cuts`` their sketch if there is one.
    """

    i: int
    rank: int
    low: float
    high: float
    size: int
    after: float = None
    cuts: tuple = None

    def bracket(self):
        """Two values that the wanted one most likely lies between."""
        at = self.rank * CUTS // self.size
        lo, hi = at - 1 - MARGIN, at + MARGIN
        return (
            self.cuts[lo] if 0 <= lo < len(self.cuts) else self.low,
            self.cuts[hi] if hi < len(self.cuts) else self.high,
        )

    def few(self):
        """Whether the bracket holds few enough values to count each."""
        return self.size * (2 * MARGIN + 2) <= COUNTED * CUTS

    def pair(self):
        """Both values, once all values here are one."""
        return self.low, self.low if self.rank + 1 < self.size else self.after


def _sketch():
    return F.percentile_approx("x", [i / CUTS for i in range(1, CUTS)], ACCURACY).alias("cuts")


def _step(size):
    """One value in so many is drawn into the sketch of ``size`` values."""
    return max(1, size // DRAWN)


def _sorted_chunks(df, columns, look, schema):
    """``look(at, x, rng)`` over the present values x, sorted, of each column and chunk of rows; it gives tuples of arrays, one per field of ``schema``.

    Tasks hold one chunk of Arrow columns; what leaves them is what ``look`` gives.
    """
    rows_held, names = max(1, CHUNK // len(columns)), [f.split()[0] for f in schema.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[f.split()[1]] for f in schema.split(", ")]

    def looked(chunk, rng):
        parts = []
        for at, column in enumerate(pa.Table.from_batches(chunk).columns):
            # adding 0 turns a negative zero into a zero
            parts += look(at, np.sort(column.drop_null().to_numpy() + 0.0), rng)
        if parts:
            fields = [np.concatenate(field) for field in zip(*parts)]
            # no value is written as not-a-number
            yield pa.RecordBatch.from_arrays([pa.array(f, k, from_pandas=True) for f, k in zip(fields, kinds)], names=names)

    def run(batches):
        rng, chunk, held = np.random.default_rng(TaskContext.get().partitionId()), [], 0
        for batch in batches:
            chunk.append(batch)
            held += batch.num_rows
            if held >= rows_held:
                yield from looked(chunk, rng)
                chunk, held = [], 0
        if held:
            yield from looked(chunk, rng)

    return df.select([c.alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, schema)


def _by_column(used, rows):
    """The tuples, numbered, of each of the used columns; the column is their first field."""
    found = [[] for _ in used]
    for k, (i, *rest) in enumerate(rows):
        found[used.index(i)].append((k, *rest))
    return found


def _sketched(df, columns, searches):
    """The searches with a sketch of the values in their bounds; searches of one column and bounds share it.

    The sketch takes every so many-th of a chunk's sorted values, from a drawn place on.
    """
    bounds = sorted({(s.i, s.low, s.high, s.size) for s in searches})
    used = sorted({b[0] for b in bounds})
    wanted = _by_column(used, [(i, low, high, _step(size)) for i, low, high, size in bounds])

    def look(at, x, rng):
        parts = []
        for k, low, high, step in wanted[at]:
            drawn = x[np.searchsorted(x, low):np.searchsorted(x, high, "right")][int(rng.integers(step))::step]
            parts.append((np.full(len(drawn), k), drawn))
        return parts

    values = _sorted_chunks(df, [columns[i] for i in used], look, "s int, x double")
    found = {row.s: tuple(row.cuts) for row in values.groupBy("s").agg(_sketch()).collect()}
    cuts = {bound: found.get(k, ()) for k, bound in enumerate(bounds)}
    return [replace(s, cuts=cuts[s.i, s.low, s.high, s.size]) for s in searches]


def _narrowed(df, columns, searches, one_by_one):
    """Each search in the part of its values that holds the rank.

    The parts are those below, at the ends of, within and above the bracket; within it every value is a part of its
    own if they are counted ``one_by_one``, else the values between its ends are sketched.
    """
    used = sorted({s.i for s in searches})
    # what lies between the ends of a bracket is about this share of the values
    inside = lambda s: s.size * (2 * MARGIN + 2) // CUTS
    wanted = _by_column(used, [(s.i, s.low, s.high, *s.bracket(), _step(inside(s))) for s in searches])
    nothing = np.nan

    def look(at, x, rng):
        parts = []
        for k, low, high, lo, hi, step in wanted[at]:
            first, last = np.searchsorted(x, low), np.searchsorted(x, high, "right")
            ends = [first, np.searchsorted(x, lo), np.searchsorted(x, lo, "right"), np.searchsorted(x, hi),
                    np.searchsorted(x, hi, "right"), last]
            ends = np.maximum.accumulate(np.clip(ends, first, last))  # a bracket of one value is its lower end
            for part, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                if a == b:
                    continue
                if one_by_one and 1 <= part <= 3:
                    value, n = np.unique(x[a:b], return_counts=True)
                    parts.append((np.full(len(n), k), np.full(len(n), part), value, n, value, value))
                else:
                    parts.append(([k], [part], [nothing], [b - a], [x[a]], [x[b - 1]]))
                    if part == 2:
                        drawn = x[a:b][int(rng.integers(step))::step]
                        none = np.full(len(drawn), nothing)
                        parts.append((np.full(len(drawn), k), np.full(len(drawn), 2), drawn, np.zeros(len(drawn), int), none, none))
        return parts

    found = _sorted_chunks(df, [columns[i] for i in used], look, "s int, part int, x double, n long, low double, high double")
    parts = found.groupBy("s", "part", *(["x"] if one_by_one else [])).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *([] if one_by_one else [_sketch()])
    )
    ranks = small_table(df.sparkSession, [(k, s.rank) for k, s in enumerate(searches)], "s int, rank long")
    # five rows per search, or one per counted value
    along = Window.partitionBy("s").orderBy("low")
    hit = parts.withColumns({
        "before": F.sum("n").over(along) - F.col("n"), "after": F.lead("low").over(along)
    }).join(F.broadcast(ranks), "s").where(
        (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
    )
    rows = {row.s: row for row in hit.collect()}
    return [
        replace(
            s, rank=s.rank - rows[k].before, low=rows[k].low, high=rows[k].high, size=rows[k].n,
            after=s.after if rows[k].after is None else rows[k].after,
            cuts=None if one_by_one or rows[k].cuts is None else tuple(rows[k].cuts),
        )
        for k, s in enumerate(searches)
    ]


def _values_at(df, columns, searches):
    """The pair of values of every search, in order."""
    values, pending = {}, dict(enumerate(searches))

    def settle():
        for k in [k for k, s in pending.items() if s.low == s.high]:
            values[k] = pending.pop(k).pair()

    def step(keys, move, *args):
        if keys:
            pending.update(zip(keys, move(df, columns, [pending[k] for k in keys], *args)))

    settle()
    while pending:
        # Only the first pass, and a search whose sketch was off, lack a sketch.
        step([k for k, s in pending.items() if s.cuts is None], _sketched)
        step([k for k, s in pending.items() if not s.few()], _narrowed, False)
        step([k for k, s in pending.items() if s.cuts is not None and s.few()], _narrowed, True)
        settle()
    return [values[k] for k in range(len(searches))]


def quantiles(df, columns, shares, facts=None):
    """Linearly interpolated quantiles: name -> list of values, None without values.

    ``columns`` maps names to numeric expressions over ``df``; ``facts`` passes
    their count, minimum and maximum if they are already known.
    """
    columns = {name: c.cast("double") for name, c in columns.items()}
    facts = facts or number_facts(df, columns)
    searches, parts = {}, {}
    for i, name in enumerate(columns):
        fact = facts[name]
        if not fact.n:
            continue
        if not math.isfinite(fact.high - fact.low):
            raise ValueError(f"infinite or not-a-number values in {name}")
        for share in shares:
            at = (fact.n - 1) * share
            searches[name, share] = _Search(i, math.floor(at), fact.low, fact.high, fact.n)
            parts[name, share] = at - math.floor(at)
    found = dict(zip(searches, _values_at(df, list(columns.values()), list(searches.values()))))

    def value(key):
        if key not in found:
            return None
        (low, high), part = found[key], parts[key]
        return low + (high - low) * part if part else low

    return {name: [value((name, share)) for share in shares] for name in columns}


def medians(df, columns, facts=None):
    return {name: values[0] for name, values in quantiles(df, columns, [0.5], facts).items()}
