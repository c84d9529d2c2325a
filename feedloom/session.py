"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MADE: list[tuple[SparkSession, str]] = []


def build_session(app: str = "feedloom", cores: str | int = "*", shuffle: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter's session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("FEEDLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local tables: keep all cores busy instead of merging shuffles into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    if shuffle:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go without (tests, bench): there it is a
    folder below the session's warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, one per call; it is removed when the program ends (``release``)."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(release)
    _MADE.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark uses for it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def release() -> None:
    """Remove the work folders of sessions that still run; results read from them have to be written by then."""
    while _MADE:
        spark, path = _MADE.pop()
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            delete_path(spark, path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a result to the shared folder and go on from there.

    It is computed once, its lineage ends, and a lost executor does not lose it. The shuffle files of the job are
    dropped as soon as the table is there.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a written table (a result of ``materialize``) that nothing will read again."""
    delete_path(table.sparkSession, table.work_path)
