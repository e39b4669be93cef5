"""Submission dumps: compressed JSON lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources.files import list_files, open_stream
from linkloom.sources.lines import numbered_text
from linkloom.sources.xz import read_xz_lines

LINES_PER_BATCH = 4096
DUMP_SCHEMA = "src_file string, line_no bigint, value string"


def codec_of(name: str) -> str:
    """Codec by substring of the file name, ``.bz2`` before ``.xz``; others by their ending."""
    base = name.rsplit("/", 1)[-1]
    for mark, codec in ((".bz2", "bz2"), (".xz", "xz")):
        if mark in base:
            return codec
    if ".zst" in base:
        raise ValueError(f"zst dumps are not supported: {name}")
    if base.endswith((".gz", ".json", ".jsonl", ".ndjson", ".txt")):
        return "text"
    raise ValueError(f"no reader for {name}")


def select_dumps(
    files: DataFrame,
    year_start: int = 2018,
    year_end: int = 2018,
    single_file: str | None = None,
    name: str = "path",
) -> DataFrame:
    """Dumps of a year range, where the year is a substring of the base name, or one file."""
    base = F.substring_index(F.col(name), "/", -1)
    if single_file is not None:
        return files.filter((base == single_file) | (F.col(name) == single_file)).distinct()
    years = [str(y) for y in range(year_start, year_end + 1)]
    wanted = base.rlike("|".join(years)) if years else F.lit(False)
    return files.filter(wanted).distinct().orderBy(name)


def read_submission_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``(src_file, line_no, value)`` of dumps, blank lines included.

    Gzip, bzip2 and plain text go through Spark's own reader (bzip2 and plain text are read in
    splits); xz, for which Spark has no codec, is read by the blocks of its index, a task for each
    range of blocks.  A bzip2 dump under another ending is streamed, one file per task.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    routed: dict[str, list[str]] = {}
    for path in paths:
        codec = codec_of(path)
        native = codec == "text" or path.endswith(".bz2")
        routed.setdefault("text" if native else "xz" if codec == "xz" else "stream", []).append(path)
    parts = []
    if "text" in routed:
        lines = numbered_text(spark, routed["text"], line_sep="\n")
        parts.append(lines.select(F.col("file").alias("src_file"), "line_no", "value"))
    if "xz" in routed:
        parts.append(read_xz_lines(spark, routed["xz"]))
    if "stream" in routed:
        files = list_files(spark, routed["stream"])
        parts.append(files.mapInArrow(_stream_lines, DUMP_SCHEMA))
    if not parts:
        return spark.createDataFrame([], DUMP_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _stream_lines(batches):
    import bz2
    import io

    import pyarrow as pa

    def emit(name, first, lines):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * len(lines), pa.string()),
                pa.array(range(first, first + len(lines)), pa.int64()),
                # Bytes that are not UTF-8 arrive as they are and are judged by the parser.
                pa.array(lines, pa.binary()).view(pa.string()),
            ],
            ["src_file", "line_no", "value"],
        )

    for batch in batches:
        for name in batch.column(0).to_pylist():
            with open_stream(name) as raw, bz2.open(io.BufferedReader(_readable(raw))) as lines:
                first, held = 0, []
                for line in lines:
                    held.append(line.removesuffix(b"\n"))
                    if len(held) == LINES_PER_BATCH:
                        yield emit(name, first, held)
                        first, held = first + len(held), []
                if held:
                    yield emit(name, first, held)


def _readable(stream):
    import io

    class Raw(io.RawIOBase):
        def readable(self):
            return True

        def readinto(self, buffer):
            data = stream.read(len(buffer))
            buffer[: len(data)] = data
            return len(data)

    return Raw()
