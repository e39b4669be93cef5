"""Opening files inside tasks, for the formats Spark has no reader for.

Only names are listed by Spark; each task streams its files through the file system that
their address names, so a file may be larger than memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``path`` of each file, spread by size over tasks; contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path"))


def _located(address: str):
    """The Arrow file system and path of an address."""
    from urllib.parse import unquote, urlsplit

    from pyarrow import fs

    parts = urlsplit(address)
    if parts.scheme in ("", "file"):
        # Spark percent-encodes local names in some columns and not in others.
        local = fs.LocalFileSystem()
        plain = address.split(":", 1)[1] if parts.scheme else address
        name = "/" + plain.lstrip("/")
        if local.get_file_info(name).type == fs.FileType.NotFound:
            name = unquote(name)
        return local, name
    return fs.FileSystem.from_uri(address)


def open_stream(address: str):
    """Raw bytes of a file on any file system Arrow knows."""
    system, name = _located(address)
    return system.open_input_stream(name, compression=None)


def open_file(address: str):
    """The same, to be read from any place."""
    system, name = _located(address)
    return system.open_input_file(name)
