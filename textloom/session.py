"""Session helpers: a local test session, the shared scratch folder, input spreading."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "textloom") -> SparkSession:
    """A local session for tests and benchmarks; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.textloom.inputPartitions", str(os.cpu_count() if cores == "*" else cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read, as the cluster names it.

    Only a local session that names none (tests) gets a temporary folder; executors of a cluster
    could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        # the setting cannot be changed on a running session: keep one folder per application
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="textloom-")
        named = _own_dirs[app]
    return named.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/textloom/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write an intermediate result that several branches read to the shared folder, and read it back."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of a few small files to the number of tasks in ``spark.textloom.inputPartitions``.

    A local session sets it to its cores. A cluster leaves it unset: its tables have many splits, and
    ``spark.sql.files.maxPartitionBytes`` is the way to change their size.
    """
    parts = df.sparkSession.conf.get("spark.textloom.inputPartitions", None)
    return df.repartition(int(parts)) if parts else df
