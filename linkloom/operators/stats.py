"""Counts and reports of the later stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.strings import lines_of


def data_archives(df: DataFrame, archive: str = "archive") -> DataFrame:
    """Archives whose whole path holds ``data`` and ends in ``.xz``."""
    return df.filter(F.col(archive).contains("data") & F.col(archive).endswith(".xz"))


def count_archives(docs: DataFrame, archive: str = "archive") -> DataFrame:
    return docs.groupBy(archive).agg(F.count("*").alias("n_docs"))


def with_total(counts: DataFrame, archive: str = "archive") -> DataFrame:
    """Counts per archive and a row with the grand total, ``is_total`` telling it from a null archive.

    The rollup runs over the counts, so the documents are not expanded twice.
    """
    total = F.grouping(archive) == 1
    return counts.rollup(archive).agg(F.sum("n_docs").alias("n_docs"), total.alias("is_total"))


def archive_counts(docs: DataFrame, archive: str = "archive") -> DataFrame:
    return with_total(count_archives(docs, archive), archive)


def update_counts(docs: DataFrame, cache: DataFrame, archive: str = "archive") -> DataFrame:
    """Count cache with the archives it lacks added; what it knows stays as it is.

    Counting comes before the anti-join, so that an archive with a third of all documents
    meets the cache as one row.
    """
    return cache.select(archive, "n_docs").unionByName(new_counts(docs, cache, archive))


def pending_archives(archives: DataFrame, cache: DataFrame, archive: str = "archive") -> DataFrame:
    """Listed archives that the cache does not hold, each once."""
    return archives.select(archive).distinct().join(cache.select(archive), archive, "left_anti")


def new_counts(docs: DataFrame, cache: DataFrame, archive: str = "archive") -> DataFrame:
    """Counts of the archives the cache does not hold."""
    return count_archives(docs, archive).join(cache.select(archive), archive, "left_anti")


def chunk_report(attempts: DataFrame) -> DataFrame:
    """Attempted, timed-out and content-yielding URLs per chunk, from ``status``."""
    keys = [c for c in ("month", "chunk_id") if c in attempts.columns]
    return attempts.groupBy(*keys).agg(
        F.count("*").alias("n_attempted"),
        F.count_if(F.col("status") == "timeout").alias("n_timed_out"),
        F.count_if(F.col("status") == "ok").alias("n_content"),
    )


def extract_report(pages: DataFrame, done: DataFrame, texts: DataFrame, keys=("month", "fid")) -> DataFrame:
    """Per month: members, members done before, and members whose extraction gave no text.

    ``texts`` holds what extraction returned for the pending members, empty texts included.
    """
    month = keys[0]
    seen = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    before = pages.select(*keys).join(seen, list(keys), "left").groupBy(month).agg(
        F.count("*").alias("n_total"), F.count_if(F.col("_done")).alias("n_done")
    )
    empty = texts.groupBy(month).agg(
        F.count_if(F.coalesce(F.length("text"), F.lit(0)) == 0).alias("_empty")
    )
    return before.join(empty, month, "left").select(
        month, "n_total", "n_done", F.coalesce("_empty", F.lit(0)).alias("n_unparsable")
    )


def token_report(lengths: DataFrame, min_length: int = 20) -> DataFrame:
    """Documents omitted for their length, and all documents."""
    return lengths.agg(
        F.count_if(F.col("n_tokens") < min_length).alias("n_omitted"), F.count("*").alias("n_total")
    )


def blank_line_stats(docs: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """Lines and omitted blank lines per file; counted inside the row, no shuffle."""
    lines = docs.select(key, lines_of(F.col(text)).alias("_l"))
    return lines.select(
        key,
        F.size("_l").cast("bigint").alias("n_lines"),
        F.size(F.filter("_l", lambda x: ~x["kept"])).cast("bigint").alias("n_blank"),
    )
