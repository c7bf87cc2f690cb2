"""Encoding, imputing and capping as a fit and an apply.

``fit`` reads the facts the matrix depends on (categories, missing shares,
medians, caps) in a handful of aggregates and returns them as a small value that
can be stored; ``apply`` is one projection, the same for training and scoring.
"""

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import settings as S
from creditloom.functions.scalar import clip, col
from creditloom.operators.columns import number_facts, stacked
from creditloom.operators.profile import distinct_values, missing_counts, numeric_columns, string_columns
from creditloom.operators.quantiles import medians, quantiles

MISSING_CLASS = "None"
DENSE_CATEGORIES = 1000  # columns of more values become a sparse vector of flags


@dataclass
class Preparation:
    """Fitted facts: columns kept, category codes, fill values and caps.

    ``filled`` lists the columns that missed values when fitted; ``medians`` has
    a value for every kept number, as later rows may miss others. ``wide`` are text
    columns of very many values: they pass the matrix as they are, for
    ``categories.flag_vectors`` to turn into one sparse vector.
    """

    numeric: list = field(default_factory=list)
    binary: dict = field(default_factory=dict)
    one_hot: dict = field(default_factory=dict)
    sparse: list = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    filled: list = field(default_factory=list)
    caps: dict = field(default_factory=dict)
    wide: list = field(default_factory=list)

    def to_json(self):
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text):
        return cls(**json.loads(text))

    def encoded(self):
        """Matrix columns in order, as (name, expression): numbers, binary codes, one-hot flags."""
        numbers = [(c, col(c)) for c in self.numeric]
        codes = [(c, _rank_code(c, values)) for c, values in self.binary.items()]
        flags = [
            (f"{c}_{value}", _is_value(c, value)) for c, values in self.one_hot.items() for value in values[1:]
        ]
        return numbers + codes + flags

    def features(self):
        """Names of the prepared feature columns."""
        return [name for name, _ in self.encoded() if name not in self.sparse]


def _rank_code(name, values):
    """Rank of the value in text order; a missing value is the class 'None'.

    A value that was not there when fitted, or the first missing one, gets the
    next code after them.
    """
    text = F.coalesce(col(name), F.lit(MISSING_CLASS))
    chain = F
    for rank, value in enumerate(values):
        chain = chain.when(text == value, F.lit(rank))
    return chain.otherwise(F.lit(len(values)))


def _is_value(name, value):
    return F.when(col(name) == value, F.lit(1)).otherwise(F.lit(0))


def plain_types(df):
    """Booleans as 0 and 1, dates and times as text; columns of other types than these, numbers and text are refused."""
    def plain(f):
        if isinstance(f.dataType, T.BooleanType):
            return col(f.name).cast("int").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col(f.name).cast("string").alias(f.name)
        if not isinstance(f.dataType, (T.NumericType, T.StringType)):
            raise TypeError(f"column {f.name} of type {f.dataType.simpleString()} has no place in the matrix")
        return col(f.name)

    if all(isinstance(f.dataType, (T.NumericType, T.StringType)) for f in df.schema):
        return df
    return df.select([plain(f) for f in df.schema])


def fit_encoding(df, label=S.LABEL, dense=DENSE_CATEGORIES):
    """Categories of every string column: up to two distinct values give codes, more give flags.

    Flags of up to ``dense`` values are columns. Columns of more values are ``wide``: their
    values are never gathered. A sketch of distinct values leaves out those of twice as many, so
    what the driver sees is bounded by the number of columns.
    """
    df = plain_types(df)
    names = string_columns(df, without=S.NOT_FEATURES + [label])
    fitted = Preparation(numeric=numeric_columns(df, without=S.NOT_FEATURES + [label]))
    if not names:
        return fitted
    about = {r.i: r.n for r in stacked(df, [col(c) for c in names]).groupBy("i").agg(
        F.approx_count_distinct("x", 0.02).alias("n")).collect()}
    few = [c for i, c in enumerate(names) if about.get(i, 0) <= 2 * dense]
    values = {name: set() for name in few}
    for row in distinct_values(df, few).select("i", "value").collect() if few else []:
        values[few[row.i]].add(row.value)
    for name in names:
        present = sorted(values.get(name, set()) - {None})
        if name not in values or len(present) > dense:
            fitted.wide.append(name)
        elif len(present) > 2:
            fitted.one_hot[name] = present
        else:
            extra = {MISSING_CLASS} if None in values[name] else set()
            fitted.binary[name] = sorted({*present, *extra})
    return fitted


def fit(df, label=S.LABEL, limit_pct=S.MISSING_LIMIT_PCT, dense=DENSE_CATEGORIES):
    """All facts of the preparation, over the rows of ``df``.

    Pass labelled and unlabelled rows together to take the statistics over both,
    or the training rows alone to keep the rest unseen.
    """
    df = plain_types(df)
    fitted = fit_encoding(df, label, dense)
    facts = number_facts(df, {**{c: col(c) for c in fitted.numeric}, "": F.lit(0)})
    rows = facts.pop("").n
    if not rows:
        raise ValueError("no rows to fit on")
    missing = {c: rows - fact.n for c, fact in facts.items()}
    fitted.sparse = [c for c in fitted.numeric if _percent(missing[c], rows) > limit_pct]
    kept = [c for c in fitted.numeric if c not in fitted.sparse]
    empty = [c for c in kept if not facts[c].n]
    if empty:
        raise ValueError(f"no value to impute from in: {empty}")
    fitted.medians = medians(df, {c: col(c) for c in kept}, facts)
    fitted.filled = [c for c in kept if missing[c]]
    fitted.caps = quantiles(df, {c: _filled(fitted, c) for c in S.CAPPED if c in kept}, [0.01, 0.99])
    return fitted


def _percent(part, whole):
    return round(part / whole * 100, 2)


def _filled(fitted, name):
    number = col(name).cast("double")
    return F.coalesce(number, F.lit(fitted.medians[name])) if name in fitted.medians else number


def encode(df, fitted, keep=(S.CUSTOMER, S.SET, S.LABEL)):
    """Strings as numbers: one projection, keys and label kept beside the matrix, wide columns as they are."""
    df = plain_types(df)
    kept = [col(c) for c in keep if c in df.columns]
    return df.select(*kept, *[e.alias(name) for name, e in fitted.encoded()], *[col(c) for c in fitted.wide])


def drop_sparse(df, fitted):
    """Without the columns that are missing too often."""
    return df.drop(*fitted.sparse)


def impute(df, fitted):
    """Missing numbers replaced by the fitted medians.

    Columns that missed values when fitted become doubles; others keep their
    type, and a whole-number one takes the median rounded.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def full(name, median):
        if name in fitted.filled or not isinstance(kinds[name], T.IntegralType):
            return F.coalesce(col(name).cast("double"), F.lit(median))
        return F.coalesce(col(name), F.lit(round(median)).cast(kinds[name]))

    return df.withColumns({c: full(c, m) for c, m in fitted.medians.items()})


def cap(df, fitted):
    """Money columns bounded by their fitted outer percentiles."""
    return df.withColumns({c: clip(col(c).cast("double"), low, high) for c, (low, high) in fitted.caps.items()})


def apply(df, fitted, keep=(S.CUSTOMER, S.SET, S.LABEL)):
    """The prepared matrix; the steps are projections that Spark collapses into one."""
    return cap(impute(drop_sparse(encode(df, fitted, keep), fitted), fitted), fitted)


def remaining_nulls(df, columns):
    """Rows (column_name, nulls) of columns that still miss values; none when all is well."""
    return missing_counts(df, columns).where("missing > 0").select("column_name", F.col("missing").alias("nulls"))


def check_no_nulls(df, columns):
    left = remaining_nulls(df, columns).collect()
    if left:
        raise ValueError(f"missing values left after imputing: {[tuple(r) for r in left]}")


def compact_types(df, tolerance=5e-4):
    """Narrowest type per numeric column that keeps its values: rows of (name, from, to).

    Whole-number columns take the smallest integer type holding their range,
    doubles become floats where no value moves by more than ``tolerance``.
    """
    numbers = [f for f in df.schema if f.dataType.simpleString() in ("int", "bigint", "double")]
    # a value beyond the float range turns infinite there, so the comparison rejects it
    if not numbers:
        return []
    moved = F.abs(F.col("x") - F.col("x").cast("float").cast("double"))
    found = stacked(df, [col(f.name).cast("double") for f in numbers]).groupBy("i").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.max(moved).alias("moved")
    )
    facts = {row.i: row for row in found.collect()}
    plan = []
    for i, f in enumerate(numbers):
        kind, fact = f.dataType.simpleString(), facts.get(i)
        if fact is None or fact.low is None:
            plan.append((f.name, kind, "float" if kind == "double" else "tinyint"))
        elif kind == "double":
            plan.append((f.name, kind, "float" if fact.moved <= tolerance else "double"))
        else:
            plan.append((f.name, kind, _narrowest(kind, fact.low, fact.high)))
    return plan


def _narrowest(kind, low, high):
    for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32)):
        if low >= -(2 ** (bits - 1)) and high < 2 ** (bits - 1):
            return name
    return kind


def compact(df, plan=None):
    """The table with every numeric column in its narrowest type; other columns untouched."""
    to = {name: target for name, _, target in (plan or compact_types(df))}
    return df.select([col(c).cast(to[c]).alias(c) if c in to else col(c) for c in df.columns])
