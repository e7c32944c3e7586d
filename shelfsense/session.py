"""Session settings and lineage cutting."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "shelfsense", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were tuned for; `conf` wins over them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`, which all executors can read.

    Only a local session may fall back to a temporary folder: executors on other machines could
    not read it, and it would not outlive them.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder for iterative operators")
        named = tempfile.mkdtemp(prefix="shelfsense-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table to the checkpoint folder and go on from there.

    A lost executor then costs no more than the current round of a loop. Unlike a checkpointed
    plan, a table read back has its true size, so the joins of the next round are planned on
    it; estimates carried from round to round would be squared every time.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/shelfsense-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class NotConverged(RuntimeError):
    """An iteration reached its last round before its tolerance."""


class Rounds:
    """Tables of a loop, one for each round; the round before is dropped once the next is stored."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark)}/shelfsense-{uuid.uuid4().hex}"
        self.n = 0

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        if self.n:
            self._drop(f"{self.folder}/{self.n - 1}")
        self.n += 1
        return self.spark.read.schema(df.schema).parquet(path)

    def _drop(self, path: str) -> None:
        jvm = self.spark._jvm
        old = jvm.org.apache.hadoop.fs.Path(path)
        old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let shuffle files of finished rounds go; Spark deletes them only once the driver has collected what names them."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage_keeping_layout(df: DataFrame) -> DataFrame:
    """Checkpoint `df` and keep its partitioning and order, for joins on the same key in a loop."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
