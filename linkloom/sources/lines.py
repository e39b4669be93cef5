"""Text files with the number of each line in its file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions.strings import month_label, year_month


def numbered_text(
    spark: SparkSession, paths, glob: str | None = None, line_sep: str | None = None
) -> DataFrame:
    """``(file, line_no, value)``: 0-based numbers, blank lines counted, files read in splits.

    A split lies in one task and its rows come in order, so a line's place in its split is its
    running id less the split's smallest.  A count per split then gives the lines before it.
    Lines are not shuffled or sorted; only the table of splits is.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    splits = lines.groupBy("file", "_block").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_n")
    )
    earlier = (
        Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = splits.select(
        "file",
        "_block",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return lines.join(starts, ["file", "_block"]).select(
        "file", (F.col("_id") + F.col("_shift")).alias("line_no"), "value"
    )


def read_url_lists(spark: SparkSession, folder, glob: str = "*.txt") -> DataFrame:
    """URL lists: ``(file, year, month_no, month, uid, url)``, where ``uid`` is the line number.

    ``month`` is the label that state and archives go by, such as ``RS_2016-01``; ``year`` and
    ``month_no`` give the order of sightings.
    """
    lines = numbered_text(spark, folder, glob)
    return lines.select(
        "file",
        year_month(F.col("file"))["year"].alias("year"),
        year_month(F.col("file"))["month"].alias("month_no"),
        month_label(F.col("file")).alias("month"),
        F.col("line_no").alias("uid"),
        F.col("value").alias("url"),
    )


def read_text_docs(spark: SparkSession, glob) -> DataFrame:
    """One document per text file: ``(path, text)``."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
