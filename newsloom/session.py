"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume. Cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A machine-local folder is used only
    when the setting is missing and the master is local, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="newsloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame, by: str) -> DataFrame:
    """Give every core a share of an input that has fewer splits than there are cores.

    A table of one small file is one task whatever its rows cost. Real tables have more splits
    than cores and pass through unchanged. ``by`` names a column of unique values; hashing it,
    unlike dealing rows out in turn, needs no sort to be repeatable after a lost task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, by)


def settle(df: DataFrame, *costly: str) -> DataFrame:
    """Keep later filters above the work that makes the ``costly`` columns.

    Spark pushes a test on a computed column down to the scan and so computes the column twice. It
    never pushes a test on a generator's output below the generator, and tests on the other
    columns still reach the scan.
    """
    rest = [c for c in df.columns if c not in costly]
    return df.select(*rest, F.inline(F.array(F.struct(*costly)))).select(*df.columns)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For a result that is used several times: it is computed once, and it outlives lost executors.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> bool:
    """Whether ``df`` stays under both bounds, found by counting its rows and bytes."""
    size = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b"),
    ).first()
    return size.n <= max_rows and (size.b or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, **bounds: int) -> DataFrame:
    """Hint a broadcast only for a frame of checked size.

    Beyond the bounds the frame comes back without a hint and Catalyst picks a shuffle join.
    """
    return F.broadcast(df) if is_small(df, **bounds) else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the cluster's shared folder; one is set only where none is."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
