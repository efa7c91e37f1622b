"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Do not record a Python stack for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "usagelens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword names use ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only where nothing is set (tests, local mode) is a local temporary folder made, once.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="usagelens-")
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path for intermediate tables or stream checkpoints."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    For results that several jobs read: they are computed once, and a lost executor costs
    reading them again.
    """
    path = scratch_path(df.sparkSession, name)
    if made := getattr(_INSIDE, "made", None):
        made[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_INSIDE = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`materialize` writes inside, when the block ends.

    For work whose results are written by then; frames made inside cannot be read afterwards. Outside of
    such a block the tables stay, as lazy results still read them. Blocks of other threads are apart.
    """
    made = _INSIDE.made = getattr(_INSIDE, "made", [])
    made.append([])
    try:
        yield
    finally:
        for path in made.pop():
            delete(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative algorithms a reliable place to cut their lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "lineage"))


def _file_system(spark: SparkSession, path: str):
    # Spark has no public call for this, so the only uses of its gateway are the four below.
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder has; none if there is no such folder."""
    files, at = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, at = _file_system(spark, old)
    if not files.rename(at, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not be renamed")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    files, at = _file_system(spark, path)
    files.delete(at, True)
