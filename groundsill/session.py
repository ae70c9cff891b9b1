"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. On a cluster these are the defaults or belong in spark-defaults.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The ids a stream has seen grow with its table: on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "groundsill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_with_tasks(module: str) -> None:
    """Send a module's functions to Python workers as code, so that executors need no copy of
    this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there, driver and executors are
    one process. A cluster session without the setting is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="groundsill-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_folder(spark: SparkSession) -> str:
    """A folder name in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/groundsill/{uuid.uuid4().hex}"


def materialize(df: DataFrame, dense: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back from there.

    Used where several branches must see the same physical rows or where recomputing them costs
    more than storing them. The copy outlives the executors that wrote it, and later readers
    still prune columns and push filters down. ``dense`` takes more time for fewer bytes, which pays for ids
    and texts.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path, compression="zstd" if dense else None)
    return spark.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session told to hand rows to Python in batches of bounded size.

    A row can be a whole document or a wide vector. Spark's usual batch of ten thousand rows would stand in
    the memory of a task three times over: in its own buffers, in Python, and as what Python makes of it.
    Most of that lies outside the heap and comes on top of it. A session that already asks for fewer rows
    is left alone.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS)) <= BATCH_ROWS:
        conf.set(_ROWS, str(BATCH_ROWS))
        conf.set(_BYTES, f"{BATCH_BYTES}b")
    return df
