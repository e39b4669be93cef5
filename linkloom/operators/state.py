"""Incremental state: what is done, what is pending, and how a run resumes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.strings import is_blank
from linkloom.operators.numbering import BUCKET_ROWS, assign_chunks, limit_pending
from linkloom.session import cut_lineage
from linkloom.sinks.reports import written_with_counts

STATE_SCHEMA = "month string, uid bigint, chunk_id bigint"


def pending_urls(urls: DataFrame, state: DataFrame, keys=("month", "uid")) -> DataFrame:
    """URLs whose id is not in the state of their month."""
    return urls.join(state.select(*keys), list(keys), "left_anti")


def pending_members(pages: DataFrame, done: DataFrame, keys=("month", "fid")) -> DataFrame:
    """Archive members that have no text yet in their month.

    Pages carry ``html``, which is not worth a shuffle: Spark broadcasts the done keys where their
    size, known from the files or at run time, allows it.
    """
    return pages.join(done.select(*keys), list(keys), "left_anti")


def append_state(state: DataFrame, done: DataFrame, keys=("month", "uid")) -> DataFrame:
    """State with the finished ids added, each once."""
    return state.select(*keys).unionByName(done.select(*keys)).distinct()


def last_chunks(state: DataFrame) -> DataFrame:
    """Last chunk id of each month."""
    return state.groupBy("month").agg(F.max("chunk_id").alias("prev"))


def resume(
    urls: DataFrame,
    state_path: str,
    data_path: str,
    process: Callable[[DataFrame], DataFrame],
    size: int = 100,
    rows: int = BUCKET_ROWS,
    max_urls: int = -1,
) -> dict[str, int]:
    """One resumable run: pending URLs, chunks, ``process``, then data, then state.

    ``process`` maps ``(month, uid, url, chunk_id)`` to the same rows with ``text`` added and,
    if it can time out, a boolean ``timed_out``.  Attempts are written before the state that
    names them, in partitions a rerun overwrites: chunk ids follow from the state alone, so a
    run that died in between is repeated into the same folders.  The state is then read off
    the written attempts; nothing is processed twice.  Timed-out URLs stay pending, empty
    results do not.  ``max_urls`` bounds the pending URLs of this run, by ``uid``; -1 is no bound.
    Returns ``n_attempted``, ``n_timed_out`` and ``n_content`` of this run, counted as it writes.
    """
    spark = urls.sparkSession
    state = read_state(spark, state_path)
    typed = urls.withColumns({"month": F.col("month").cast("string"), "uid": F.col("uid").cast("bigint")})
    pending = limit_pending(pending_urls(typed, state), max_urls, rows=rows)
    plan = cut_lineage(assign_chunks(pending, size, last_chunks(state), rows=rows))
    attempts = process(plan)
    if "timed_out" not in attempts.columns:
        attempts = attempts.withColumn("timed_out", F.lit(False))
    status = (
        F.when(F.col("timed_out"), "timeout").when(is_blank(F.col("text")), "empty").otherwise("ok")
    )
    attempts = attempts.withColumn("status", status).drop("timed_out")
    counts = {
        "n_attempted": F.lit(True),
        "n_timed_out": F.col("status") == "timeout",
        "n_content": F.col("status") == "ok",
    }
    report = written_with_counts(
        attempts.repartition("month", "chunk_id"), counts, lambda rows: _write_attempts(rows, data_path)
    )
    written = _read_if_any(spark, data_path, attempts.schema)
    if written is None:
        return report
    keys = ["month", "uid", "chunk_id"]
    finished = _new_chunks(written, plan).filter("status != 'timeout'").select(*keys)
    finished.join(plan.select(*keys), keys, "left_semi").write.mode("append").parquet(state_path)
    return report


def _write_attempts(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "chunk_id")
        .parquet(path)
    )


def _new_chunks(written: DataFrame, plan: DataFrame, months: int = 1000) -> DataFrame:
    """Prune the attempts to folders this run may have written."""
    first = plan.groupBy("month").agg(F.min("chunk_id").alias("chunk_id"))
    bounds = first.limit(months + 1).collect()
    if len(bounds) > months:
        return written
    recent = F.lit(False)
    for month, chunk_id in bounds:
        recent = recent | ((F.col("month") == month) & (F.col("chunk_id") >= chunk_id))
    return written.filter(recent)


def _read_if_any(spark, path: str, schema) -> DataFrame | None:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_state(spark, path: str) -> DataFrame:
    found = _read_if_any(spark, path, STATE_SCHEMA)
    return spark.createDataFrame([], STATE_SCHEMA) if found is None else found


def committed_documents(data: DataFrame, state: DataFrame) -> DataFrame:
    """Documents with content whose attempt the state names."""
    keys = ["month", "uid", "chunk_id"]
    return data.filter("status = 'ok'").join(state.select(*keys), keys, "left_semi")
