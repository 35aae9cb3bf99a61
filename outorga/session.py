"""Session settings. Everything here can be changed on a running session."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split oversized partitions even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def session(app: str = "outorga", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


#: Shared folder of local sessions that name none.
LOCAL_SHARED = "/tmp/checkpoints/outorga"


def ensure_shared(spark: SparkSession) -> SparkSession:
    """Name a shared folder where the session has none. For entry points: a cluster names its own in
    ``spark.checkpoint.dir``, or whoever runs the job in the OUTORGA_SHARED variable. Only a local session, whose
    executors are this process, gets a folder of this machine; any other one without a name is refused."""
    if not _shared(spark):
        named = os.environ.get("OUTORGA_SHARED")
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir (or OUTORGA_SHARED) to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(named or LOCAL_SHARED)
    return spark


def _shared(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """Path of a new folder below the one named in ``spark.checkpoint.dir``."""
    shared = _shared(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{shared.rstrip('/')}/outorga-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it. (A cluster whose machines don't
    share that folder gets the package by ``--py-files`` or an installation.)"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


#: Of tables that a run writes down for itself: two thirds of the bytes of Spark's own choice, in the same time.
CODEC = "zstd"


def cut_lineage(df: DataFrame, codec: str | None = CODEC, deltas: bool = False) -> DataFrame:
    """Write the rows to the shared folder and go on from there. As Parquet, so that those who read
    on take only the columns they need and the planner knows the size. Without a ``codec``, that of the session.
    ``deltas`` writes numbers as differences: for rows in order of dense ids, whose ids then take next to nothing."""
    path = new_folder(df.sparkSession)
    writer = df.write.option("compression", codec) if codec else df.write
    (writer.option("parquet.writer.version", "PARQUET_2_0") if deltas else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Jobs that ``begun`` lets run at the same time.
JOBS = 3


def begun(spark: SparkSession, jobs: list[Callable]) -> list[Future]:
    """Start jobs that don't need each other, in this order and a few at a time: the tasks of one use the cores that the
    last tasks of another leave idle. A future's ``result()`` waits for its job and raises what it raised."""

    def inheriting(job: Callable) -> Callable:
        """The job with the session's tags and properties, a copy of its own."""
        target = inheritable_thread_target(spark)
        return target(job) if callable(target) else job  # the session comes back where threads are not pinned

    pool = ThreadPoolExecutor(JOBS)
    futures = [pool.submit(inheriting(job)) for job in jobs]
    pool.shutdown(wait=False)
    return futures


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input that arrives in fewer pieces than the cluster has cores: a small file,
    or a few gzip or multi-line ones that no reader can split. Bigger inputs pass as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
