"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that decide results or keep skewed groups spread out. All can be
#: changed on a running session; cluster sizing (executors, shuffle partitions)
#: stays with whoever submits the job.
RUNTIME_CONF = {
    # DATE(ts) is a UTC date in every layer.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Splits skewed join and rebalance partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "hearthlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir`` falls back to the
    machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="hearthlake-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Staging:
    """Intermediate results of one run, in one folder that goes when the run ends.

    ``keep`` writes a frame once and reads it back. Used where a result feeds
    several actions: the work is not repeated, the lineage is cut in a way that
    survives lost executors, and the planner sees the true size when it chooses a
    join.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = work_dir(spark, "run")
        self._count = 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @classmethod
    def lasting(cls, spark: SparkSession) -> Staging:
        """For results that are computed after the call that makes them: the folder goes when the process ends."""
        own = cls(spark)

        def remove() -> None:
            with contextlib.suppress(Exception):  # the session may be gone by then
                own.remove()

        atexit.register(remove)
        return own

    def folder(self, label: str) -> str:
        """A fresh folder for files of other kinds, which goes with the rest."""
        self._count += 1
        return f"{self.root}/{self._count:03d}-{label}"

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_error) -> None:
        self.remove()

    def remove(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
