"""Session settings, lineage cutting and the scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. All can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

_LOCAL_DIRS: dict[str, str] = {}
_STAGED: list[str] = []


def get_session(app: str = "tallyweave", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already has."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tallyweave-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, for staged tables."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back.

    For a result that several later jobs read, this keeps its column statistics
    and lets each reader prune columns, which a checkpointed RDD cannot.
    """
    path = scratch_path(df.sparkSession, name)
    _STAGED.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def staged_paths() -> list[str]:
    """Tables that :func:`staged` wrote in this process and that are still there, in order."""
    return list(_STAGED)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged tables that no frame reads any more; tables of others are left alone."""
    jvm = spark.sparkContext._jvm
    for path in [p for p in paths if p in _STAGED]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _STAGED.remove(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing holds any more.

    Spark does so when the driver's heap is collected, which a large heap may put off for many rounds of a loop.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Bounded size check; reads no more than ``rows + 1`` result rows."""
    return df.limit(rows + 1).count() <= rows


def spread(df: DataFrame, *columns) -> DataFrame:
    """Rows over all cores by a hash of ``columns``, for steps that compute much per row.

    A small input would otherwise stay in one file split, hence one task. The explicit number keeps
    adaptive execution from merging the partitions again.
    """
    spark = df.sparkSession
    return df.repartition(
        max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *columns
    )
