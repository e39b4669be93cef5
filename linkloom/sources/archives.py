"""Document archives: every member of a tar file as a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.sources.files import list_files, open_stream

BATCH_BYTES = 16 << 20
MEMBERS_PER_BATCH = 1024
ARCHIVE_SCHEMA = "archive string, member string, content string"


def read_archives(
    spark: SparkSession, path, glob: str | None = None, content: bool = True
) -> DataFrame:
    """``(archive, member, content)`` of the tar files of a folder; see ``read_members``."""
    return read_members(list_files(spark, path, glob), content)


def read_members(paths: DataFrame, content: bool = True) -> DataFrame:
    """``(archive, member, content)`` of tar files, compressed or not (xz, bz2, gz).

    ``paths`` has the addresses in its only column; files that are not in it are not opened.

    Archives are streamed front to back, one per task, and never unpacked to disk; the number
    of rows in flight is bound by their size.  ``content=False`` reads names only.
    """

    def members(batches):
        import tarfile

        import pyarrow as pa

        def emit(name, rows):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(rows), pa.string()),
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.string()),
                ],
                ["archive", "member", "content"],
            )

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_stream(name) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                    for member in tar:
                        body = None
                        if content and member.isfile():
                            body = tar.extractfile(member).read().decode("utf-8", "replace")
                            held += len(body)
                        rows.append((member.name, body))
                        # The library remembers every header unless told to forget.
                        tar.members = []
                        if held >= BATCH_BYTES or len(rows) >= MEMBERS_PER_BATCH:
                            yield emit(name, rows)
                            rows, held = [], 0
                if rows:
                    yield emit(name, rows)

    return paths.mapInArrow(members, ARCHIVE_SCHEMA)
