"""Running functions of this package on the executors' Python workers."""

import os

import pyarrow as pa

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _find_package(spark):
    """Let workers import the package from where the driver did, besides their own paths.

    On a cluster the package is installed or sent with the job; then this adds nothing.
    """
    paths = spark.sparkContext.environment
    if _ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (paths.get("PYTHONPATH"), _ROOT) if p)


def map_batches(df, function, schema):
    """``df.mapInArrow`` with workers that find this package."""
    def run(batches):
        yield from function(batches)
        # Workers are used again and again; what one step held is of no use to the next.
        pa.default_memory_pool().release_unused()

    _find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df, key, function, schema):
    """``df.groupBy(key).applyInArrow`` with workers that find this package; groups must be bounded."""
    _find_package(df.sparkSession)
    return df.groupBy(key).applyInArrow(function, schema)


def map_pairs(left, left_key, right, right_key, function, schema):
    """Cogroups two frames by a key for ``function(left rows, right rows)``; groups must be bounded.

    Only one group at a time is in a task's Arrow memory.
    """
    def run(left_rows, right_rows):
        out = function(left_rows, right_rows)
        pa.default_memory_pool().release_unused()
        return out

    _find_package(left.sparkSession)
    return left.groupBy(left_key).cogroup(right.groupBy(right_key)).applyInArrow(run, schema)
