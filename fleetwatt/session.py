"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process wrote and nobody has removed yet, and applications that have the package.
_WRITTEN: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here assumes.

    Clock arithmetic is naive UTC.  Adaptive execution splits hot join partitions, even
    where that costs a shuffle, and picks broadcast joins from measured sizes.  Ranked
    limits (``row_number <= n``) cut each task's rows before the shuffle.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="fleetwatt-"), "fleetwatt.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def local_session(cores: str = "8", partitions: str = "8", name: str = "fleetwatt") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; pick one only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="fleetwatt-checkpoint-")
    context.setCheckpointDir(named)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute a table once that several branches read.

    It is written to the shared folder, so losing an executor loses nothing, and read
    back as parquet, so later plans prune columns and know its size.  It is removed at the
    end of the ``scratch`` block around it, or else when the process ends.
    """
    path = shared_path(df.sparkSession, name)
    _WRITTEN.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _remove(tables: list[tuple[SparkSession, str]]) -> None:
    for spark, path in tables:
        if spark.sparkContext._jsc is not None:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Intermediate tables written inside the block are removed at its end.

    Results must be collected or written before that.
    """
    begun = len(_WRITTEN)
    try:
        yield
    finally:
        mine, _WRITTEN[begun:] = _WRITTEN[begun:], []
        _remove(mine)


@atexit.register
def _remove_all() -> None:
    tables, _WRITTEN[:] = list(_WRITTEN), []
    try:
        _remove(tables)
    except Exception:  # the session has ended before; its folder is the cluster's to clear
        return
