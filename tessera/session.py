"""Session helpers: sane defaults for local tests, shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

# Defaults applied only by ``local_session`` (tests, bench, smoke runs).
# On a cluster the caller's session keeps its own settings.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that leaves it unset gets a scratch folder of our
    own; on a cluster the driver's folders are not the executors', so an
    unset folder raises there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:  # a folder already given to this SparkContext
        d = spark.sparkContext.getCheckpointDir()
        master = spark.sparkContext.master
    except PySparkNotImplementedError:  # Spark Connect: no context to ask
        d, master = None, spark.conf.get("spark.master", "")
    if d:
        return d
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    global _LOCAL_CKPT
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="tessera-ckpt-")
    return _LOCAL_CKPT


_LOCAL_CKPT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder (Spark makes it).

    Iterative MLlib jobs (ALS, trees with ``checkpointInterval``) cut their
    lineage there, so a lost executor does not replay every iteration.
    """
    d = checkpoint_dir(spark)
    try:
        sc = spark.sparkContext
    except PySparkNotImplementedError:  # Spark Connect: the server owns the folder
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows out evenly over ``partitions`` (default: the session's
    ``spark.sql.shuffle.partitions``), whatever the layout of the input.

    For the input of an iterative fit (trees, CV, k-means, ALS), which is read
    many times: its one exchange costs less than passes over a few unequal
    scan splits, and fits that depend on the layout give the same result for
    the same setting. Lazy: nothing runs until the fit.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def held(df: DataFrame, cols: list[str] | None = None) -> Iterator[DataFrame]:
    """The columns an iterative fit reads, spread and persisted while it runs.
    A table that the caller has persisted is used as it is, so no rows are
    held twice."""
    x = df.select(*cols) if cols else df
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield x
        return
    x = spread(x).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield x
    finally:
        x.unpersist()
