"""Session helpers."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only local runs fall back to a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="yardline-checkpoint-")
    sc.setCheckpointDir(folder)


def tune(spark: SparkSession) -> None:
    """The JVM never compiles methods above 8000 bytes. The wide play expressions generate longer ones, so
    have Spark use its split, compiled code for those stages instead (two to three times faster here)."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


@contextlib.contextmanager
def shared_partitions(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside stay with rows that are dealt out by some of their keys, and deal out only the other side. By
    default Spark moves both by all keys, against skew; only for keys that hold few rows by what they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("yardline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def settle(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from its files.

    For tables that the following steps read several times: each reader scans the columns it needs
    instead of repeating the plan, sizes are known when joins are planned, and a lost executor costs no
    recomputation. The files go when Python ends, or earlier by ``drop_files``.
    """
    return settle_at(df)[0]


def settle_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``settle``, with the place of the files."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def scratch_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate files: under the checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; what is written there goes when Python ends."""
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    at_end(lambda: drop_files(spark, path))
    return path


def drop_files(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_CLEANUP: list[Callable[[], object]] = []


def at_end(action: Callable[[], object]) -> None:
    """Run an action when Python ends if Spark still runs then."""
    if not _CLEANUP:
        atexit.register(clean_up)
    _CLEANUP.append(action)


def clean_up() -> None:
    """Delete what intermediate tables were written; results that still read them can't be computed after that."""
    while _CLEANUP:
        action = _CLEANUP.pop()
        if SparkContext._active_spark_context is not None:
            with contextlib.suppress(Exception):  # the JVM may be gone
                action()
