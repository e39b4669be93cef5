"""Helpers of the operators: tables in the shared folder, row numbers, Arrow batches."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkloom.session import shared_folder

# Deletes the characters of [\x20\x09-\x0D]; also what bytes.split() splits at.
WHITE = b" \t\n\x0b\x0c\r"


_PATHS: WeakKeyDictionary = WeakKeyDictionary()
_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def written(df: DataFrame, *partitions: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{_FOLDER.get() or shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def remove(table: DataFrame) -> None:
    """Delete a table that ``written`` returned and that nothing reads any more."""
    _delete(table.sparkSession, _PATHS.pop(table))


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside go to one folder, which is deleted at the end.

    Yields a function that writes a table outside of it, as what is read from the folder is lost.
    """
    outer, folder = _FOLDER.get(), f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def keep(df: DataFrame) -> DataFrame:
        token = _FOLDER.set(outer)
        try:
            return written(df)
        finally:
            _FOLDER.reset(token)

    token = _FOLDER.set(folder)
    try:
        yield keep
    finally:
        _FOLDER.reset(token)
        _delete(spark, folder)


def free_name(df: DataFrame, name: str) -> str:
    """A name for a new column, unlike any that ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


class Intervals:
    """A set of places in a text, as intervals that are kept apart and in order."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts, self.ends = [], []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            elif start < end:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        """Whether some place of the span is in the set."""
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def add(self, start: int, end: int) -> None:
        """Add a span that touches none."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def rows_of_task() -> Iterator[int]:
    """Row numbers no other task of the stage hands out: the partition in the high bits."""
    from pyspark import TaskContext

    n = TaskContext.get().partitionId() << 40
    while True:
        yield n
        n += 1


def values(batch: pa.RecordBatch, name: str) -> Iterator:
    """The values of a column one by one, so that long texts are not all held twice."""
    column = batch.column(batch.schema.get_field_index(name))
    return (v.as_py() for v in column)
