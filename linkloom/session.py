"""Session settings and small shared helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "linkloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LINKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may leave it unset and gets a temporary folder; on a cluster a folder of
    the driver's machine would be invisible to the executors, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-shared-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Size check before broadcasting or collecting; tasks send counts, not rows."""
    return df.count() <= rows


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a one-row ``inline``.

    The optimizer pushes a filter below a projection by copying the projected expressions into
    it, so that a costly one (JSON parsing) would run for the filter and again for the result.
    It does not push filters on a generator's output.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))
