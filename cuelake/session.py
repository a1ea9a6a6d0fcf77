"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Build a session; on a cluster leave every argument out and submit-time settings apply."""
    builder = (
        SparkSession.builder.appName("cuelake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording a Python call site for every column costs more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode (tests), where one
    machine runs everything. On a cluster an unset folder is an error: executors could not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="cuelake-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, deleted when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/cuelake-{name}-{uuid.uuid4().hex}"
    atexit.register(drop_folder, spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the data lands in the shared folder, so lost executors cost nothing."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Hash rows over all shuffle partitions ahead of work that is heavy per byte.

    Adaptive coalescing sizes tasks by bytes, which would leave costly text comparison to a few
    tasks; a fixed partition count is not coalesced.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write the result of one step now and read it back.

    Shuffle files stay as long as the query that wrote them. With the step done nothing refers to its files
    any more, and a collection on the driver lets Spark's cleaner delete them ahead of the next step.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path, compression="zstd")
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


_STAGED: dict[tuple[str, str], str] = {}


DEALT_ROWS = 1000


def staged(source: DataFrame, derive: Callable[[DataFrame], DataFrame], name: str, deal: bool = True) -> DataFrame:
    """Write `derive(source)` once per application as a table in the shared folder and read it back.

    For a derived table that many queries read: later scans prune columns instead of deriving
    every row again, and a lost executor only rereads files. A file with few row groups is read by
    few tasks, so the source is first copied into small files as it streams by: the heavy part then
    runs on every core, and no task holds, sorts or spills a shuffle of the whole input. Not needed
    (`deal` off) where the source itself is such a table.
    """
    spark = source.sparkSession
    key = (spark.sparkContext.applicationId, name)
    if key not in _STAGED:
        path = scratch_folder(spark, "staged")
        if deal:
            dealt = scratch_folder(spark, "dealt")
            source.write.option("maxRecordsPerFile", DEALT_ROWS).parquet(dealt, compression="zstd")
            derive(spark.read.schema(source.schema).parquet(dealt)).write.parquet(path, compression="zstd")
            drop_folder(spark, dealt)
        else:
            derive(source).write.parquet(path, compression="zstd")
        _STAGED[key] = path
    return spark.read.schema(derive(source).schema).parquet(_STAGED[key])
