"""URL lists, document chunks, texts, token shards and the count cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.stats import new_counts
from linkloom.session import cut_lineage

FILE_ROWS = 5_000_000
TEXT_FILES = 64


def _clustered(df: DataFrame, *order: str) -> DataFrame:
    """Rows in order, cut into ranges of even size; file numbers follow the order.

    A range exchange runs its input once for a sample and once for the rows, so the input is made
    once before.  For narrow rows only.
    """
    return cut_lineage(df).repartitionByRange(*order).sortWithinPartitions(*order)


def write_url_lists(
    df: DataFrame, path: str, codec: str = "none", by: str = "month", order: str = "uid"
) -> None:
    """URL lists as text, one URL per line in order, a folder per source."""
    if codec not in ("none", "gzip", "bzip2"):
        raise ValueError(f"text files cannot be written as {codec}")
    (
        _clustered(df.select(by, order, F.col("url").alias("value")), by, order)
        .drop(order)
        .write.mode("overwrite")
        .option("compression", codec)
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(by)
        .text(path)
    )


def write_chunks(
    df: DataFrame, path: str, codec: str = "zstd", format: str = "parquet", text: str = "text"
) -> None:
    """Documents with their metadata per (month, chunk); rows without text are left out.

    A chunk is bounded by its size, so each gets one task and one file.  ``json`` is the
    uncompressed form that any reader opens.
    """
    docs = df.filter(F.length(text) > 0).repartition("month", "chunk_id")
    writer = docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if format == "json":
        writer.partitionBy("month", "chunk_id").json(path)
    else:
        writer.option("compression", codec).partitionBy("month", "chunk_id").parquet(path)


def write_text(df: DataFrame, path: str, key: str = "fid") -> None:
    """Extracted text by month, added to what is there; a month is spread over ``TEXT_FILES`` files."""
    spread = F.pmod(F.xxhash64(key), F.lit(TEXT_FILES))
    df.repartition("month", spread).write.mode("append").partitionBy("month").parquet(path)


def write_token_shards(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Shard rows ``(batch_id, shard_id, pos, ids)``, a folder per batch.

    A shard lies in one file, in order of ``pos``: its size is bounded by how shards are closed.
    """
    (
        df.repartition("batch_id", "shard_id")
        .sortWithinPartitions("batch_id", "shard_id", "pos")
        .write.mode("overwrite")
        .option("compression", codec)
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_counts(docs: DataFrame, cache: DataFrame, path: str, archive: str = "archive") -> bool:
    """Write the count cache with new archives added; nothing is written if none is new.

    ``path`` must differ from where ``cache`` is read: a table cannot replace itself.
    """
    return add_counts(new_counts(docs, cache, archive), cache, path, archive)


def add_counts(new: DataFrame, cache: DataFrame, path: str, archive: str = "archive") -> bool:
    """The same for counts already made, as by ``count_new``; they are made once."""
    fresh = cut_lineage(new.select(archive, "n_docs"))
    if fresh.isEmpty():
        return False
    cache.select(archive, "n_docs").unionByName(fresh).write.mode("overwrite").parquet(path)
    return True
