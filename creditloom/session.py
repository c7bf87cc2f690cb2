"""Session builder and the shared folder for stage tables."""

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T


def build_session(name="creditloom", master=None, **conf):
    """A session with the settings the engine relies on.

    The UTC time zone fixes day offsets; adaptive execution coalesces small
    shuffle partitions and splits skewed ones. Memory and parallelism stay with
    the cluster's own configuration unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}


def small_table(spark, rows, schema):
    """A table from a few facts held by the driver, planned as local rows."""
    fields = T.StructType.fromDDL(schema).fields
    columns = [
        pa.array([row[i] for row in rows], _ARROW[f.dataType.simpleString()]) for i, f in enumerate(fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=[f.name for f in fields]))


def size_shuffles(spark, tables, target_bytes=128 * 2**20, most=200_000):
    """Start shuffles with enough partitions for the inputs' size, about ``target_bytes`` each.

    Adaptive execution merges partitions that turn out small but never splits
    ordinary ones, so the start has to be fine enough.
    """
    size = sum(
        int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in tables
    )
    start = min(most, max(size // target_bytes, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return start


def shared_folder(spark):
    """The folder every executor can read and write.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="creditloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark, name):
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), "creditloom", f"{name}-{uuid.uuid4().hex}")


def find_package(spark):
    """Let Python workers import this package from where the driver did, besides their own paths.

    On a cluster the package is installed or sent with the job; then this adds nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (paths.get("PYTHONPATH"), root) if p)


def path_exists(spark, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
