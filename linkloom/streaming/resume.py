"""The resumable chunk loop as a stream: new URL files in, attempts and state out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.numbering import BUCKET_ROWS
from linkloom.operators.state import resume

URL_SCHEMA = "month string, uid bigint, url string"


def resume_stream(
    spark: SparkSession,
    url_path: str,
    state_path: str,
    data_path: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame],
    size: int = 100,
    rows: int = BUCKET_ROWS,
    max_files: int = 1000,
    max_urls: int = -1,
) -> StreamingQuery:
    """Run ``resume`` on each batch of new URL files (Parquet), until none is left.

    The checkpoint remembers files and the state table remembers URLs.  A batch that failed
    half-way is repeated with the same chunk ids and overwrites its own folders.  With ``max_urls``
    a batch takes up so many URLs at most; the rest stays pending for a run of ``resume``.
    """
    urls = (
        spark.readStream.schema(URL_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(url_path)
    )

    def run(batch: DataFrame, _: int) -> None:
        resume(batch, state_path, data_path, process, size, rows, max_urls)

    return (
        urls.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
