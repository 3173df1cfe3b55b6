import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, held, spread

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_checkpoint_dir_read_from_session(spark):
    want = spark.conf.get("spark.checkpoint.dir", None)
    if want:
        assert checkpoint_dir(spark) == want


def test_checkpoint_dir_fallback_when_unset(tmp_path):
    """With no spark.checkpoint.dir at all, a scratch folder is used and
    checkpointing jobs (exact AUC) still run."""
    conf = tmp_path / "conf"
    conf.mkdir()
    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        assert spark.conf.get("spark.checkpoint.dir", None) is None
        from tessera.operators import evaluate as EV
        df = spark.createDataFrame([(1.0, 0.3), (0.0, 0.1), (1.0, 0.9)], "label double, score double")
        print("AUC", EV.auc(df).first().auc)
    """)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True,
                         text=True, timeout=240)
    assert "AUC 1.0" in out.stdout, out.stderr[-2000:]


def test_spread_is_lazy_and_even(spark):
    df = spark.range(1000).coalesce(1).groupBy((F.col("id") % 7).alias("k")).count()
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    out = spread(df, 5)
    assert set(tracker.getJobIdsForGroup(None)) == before     # nothing ran
    assert out.rdd.getNumPartitions() == 5
    want = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread(spark.range(10)).rdd.getNumPartitions() == want


def test_held_rows_are_not_held_twice(spark):
    df = spark.range(100)
    with held(df) as x:
        assert x.storageLevel.useMemory
        x.count()
        before = len(spark.sparkContext._jsc.getPersistentRDDs())
        with held(x) as y:
            y.count()
            assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
        assert x.storageLevel.useMemory
    assert not x.storageLevel.useMemory


def test_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
