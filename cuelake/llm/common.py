"""Shared helpers of the training-text operators: staged tables, components, table reading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not use, whatever the case of letters."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def few_at_a_time(batches, column: int = 1, rows: int = 512, size: int = 1 << 20):
    """Arrow batches cut to at most `rows` rows and about `size` bytes of text; a longer text comes alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            n = min(rows, max(1, int(np.searchsorted(ends, before + size, side="right")) - at))
            yield batch.slice(at, n)
            at += n


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset (tests, one machine) a folder of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage ends there, so a lost
    executor costs a reread, and later scans take only the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v) links: (node, root), root the smallest node reachable.

    Large-star and small-star rounds on minima, without neighbour lists: a hot node is a skewed
    join key, not a group held in memory. Rounds end when no link changes; their number follows
    the logarithm of the longest chain. Each round is a staged table, the one before is deleted.
    """
    links = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.union(links.groupBy("u").agg(F.min("v").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        nxt = stage(small.select("e.*").where("u <> v").distinct(), "links")
        now = tuple(nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
        unstage(links)
        links = nxt
        if now == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
