"""Intermediate tables in the folder all executors share."""

from pyspark.sql import functions as F

from creditloom.session import fresh_path

# A side of a join is broadcast only up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """A folder below the shared one that holds the tables of one operator run.

    A kept table cuts the lineage: executors lost later cost only what was done
    since. Tables stay as long as results that read them may be used; ``drop``
    removes one that no later step reads.
    """

    def __init__(self, spark, name):
        self.spark = spark
        self.folder = fresh_path(spark, name)

    def keep(self, df, name, batch_bytes=None):
        """Write ``df`` and read it back; the shuffle files of the write are removed when it is done.

        ``batch_bytes``: of the Arrow batches that Python steps of ``df`` get, about; else the session's limit.
        """
        path, settings = f"{self.folder}/{name}", {CLEANUP: "true", **({BATCH: str(batch_bytes)} if batch_bytes else {})}
        before = {key: self.spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                self.spark.conf.set(key, value)
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df):
    """``df`` marked for broadcast if its counted rows are few, else as it is.

    ``df`` should be a kept table, as it is counted here.
    """
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def fresh_name(name, taken):
    """``name``, lengthened until no column in ``taken`` has it (names compare without case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def let(value, body):
    """``body(value)`` with ``value`` computed once per row.

    A column used inside another column's lambda would be computed anew for each
    element once the optimizer merges the projections; a lambda's argument is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
