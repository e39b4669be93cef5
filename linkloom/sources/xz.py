"""xz files in parallel: one split for each range of blocks.

An xz file ends in an index of its blocks, which can be decompressed one by one.  The index of each
file is read in a task; its blocks are grouped into splits of bounded size, and each split is read by a
task of its own.  A split takes the lines that begin in it or at its very end: it leaves out what comes
before its first newline and reads on into the next block to end its last line, as line-based input
formats do.  Files of one block, as the plain ``xz`` command writes them, are one split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.sources.files import list_files, open_file

#: Uncompressed bytes of a split, where blocks are smaller.
SPLIT_BYTES = 64 << 20
LINES_PER_BATCH = 4096
_HEADER, _MAGIC, _END = 12, b"\xfd7zXZ\x00", b"YZ"

SPLIT_SCHEMA = "src_file string, split int, blocks array<struct<start bigint, header bigint, size bigint, length bigint>>"


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A number of 7 bits a byte, and where the next one starts."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def block_index(source) -> list[tuple[int, int, int, int]]:
    """Blocks of an xz file in order: ``(start, header, size, length)``.

    ``start`` is where the block begins, ``header`` where the header of its stream does, ``size`` its
    bytes in the file with padding, and ``length`` its uncompressed bytes.  Streams that follow one
    another, with zero bytes between them, are all found, from the last to the first.
    """

    def read(start: int, n: int) -> bytes:
        source.seek(start)
        data = source.read(n)
        if len(data) != n:
            raise ValueError("the file ends too early for xz")
        return data

    out: list[tuple[int, int, int, int]] = []
    end = source.size()
    while end > 0:
        if end % 4 or end < 2 * _HEADER:
            raise ValueError("not an xz file")
        if read(end - 4, 4) == b"\0\0\0\0":
            end -= 4
            continue
        footer = read(end - _HEADER, _HEADER)
        if footer[10:] != _END:
            raise ValueError("not an xz file")
        index_size = (int.from_bytes(footer[4:8], "little") + 1) * 4
        index = read(end - _HEADER - index_size, index_size)
        count, at = _number(index, 1)
        sizes = []
        for _ in range(count):
            unpadded, at = _number(index, at)
            length, at = _number(index, at)
            sizes.append(((unpadded + 3) // 4 * 4, length))
        header = end - _HEADER - index_size - sum(size for size, _ in sizes) - _HEADER
        if header < 0 or read(header, 6) != _MAGIC:
            raise ValueError("not an xz file")
        start, blocks = header + _HEADER, []
        for size, length in sizes:
            blocks.append((start, header, size, length))
            start += size
        out = blocks + out
        end = header
    return out


def _splits(split_bytes: int):
    import pyarrow as pa

    block = pa.struct([(c, pa.int64()) for c in ("start", "header", "size", "length")])
    names = ["src_file", "split", "blocks"]

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_file(name) as source:
                    blocks = _indexed(source)
                groups, held = [], 0
                for b in blocks:
                    if not b["length"]:
                        continue
                    if not groups or held + b["length"] > split_bytes:
                        groups.append([])
                        held = 0
                    groups[-1].append(b)
                    held += b["length"]
                for k, group in enumerate(groups):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([k], pa.int32()), pa.array([group], pa.list_(block))], names
                    )

    return run


def _pieces(source, blocks, piece: int = 1 << 20):
    """The uncompressed bytes of blocks, in pieces of bounded size."""
    import lzma

    for b in blocks:
        source.seek(b["header"])
        # A stream's header in front of any of its blocks is the beginning of a valid stream.
        decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
        decoder.decompress(source.read(_HEADER))
        source.seek(b["start"])
        left, made = b["size"], 0
        while made < b["length"]:
            data = b""
            if decoder.needs_input:
                data = source.read(min(left, piece))
                left -= len(data)
                if not data:
                    raise ValueError("a block of xz ends too early")
            out = decoder.decompress(data, min(piece, b["length"] - made))
            made += len(out)
            if out:
                yield out


def _lines(source, split: int, blocks: list[dict]):
    """Lines that belong to the split, without their newlines."""
    held, skip = [], split > 0  # pieces of a line that is not ended yet
    for data in _pieces(source, blocks):
        if skip:
            at = data.find(b"\n")
            if at < 0:
                continue
            data, skip = data[at + 1 :], False
        first, *lines = data.split(b"\n")
        held.append(first)
        if lines:
            yield b"".join(held)
            yield from lines[:-1]
            held = lines[-1:]
    if skip:  # a line that began before goes beyond this split
        return
    last = blocks[-1]["start"]  # the last line may end in any block behind
    for data in _pieces(source, [b for b in _indexed(source) if b["start"] > last and b["length"]]):
        at = data.find(b"\n")
        held.append(data if at < 0 else data[:at])
        if at >= 0:
            yield b"".join(held)
            return
    rest = b"".join(held)
    if rest:  # the end of the file
        yield rest


def _indexed(source) -> list[dict]:
    return [dict(zip(("start", "header", "size", "length"), b)) for b in block_index(source)]


def _read(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            name, split = row["src_file"], row["split"]
            with open_file(name) as source:
                first, held = 0, []
                for line in _lines(source, split, row["blocks"]):
                    held.append(line)
                    if len(held) == LINES_PER_BATCH:
                        yield _rows(pa, name, split, first, held)
                        first, held = first + len(held), []
                if held:
                    yield _rows(pa, name, split, first, held)


def _rows(pa, name, split, first, lines):
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(lines), pa.string()),
            pa.array([split] * len(lines), pa.int32()),
            pa.array(range(first, first + len(lines)), pa.int64()),
            # Bytes that are not UTF-8 arrive as they are and are judged by the parser.
            pa.array(lines, pa.binary()).view(pa.string()),
        ],
        ["src_file", "split", "pos", "value"],
    )


def xz_splits(spark: SparkSession, path, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``src_file, split, blocks`` of xz files, one row a task."""
    found = list_files(spark, path).mapInArrow(_splits(split_bytes), SPLIT_SCHEMA)
    n = max(1, found.count())  # reads the ends of the files only
    return found.repartition(n)


def read_xz_lines(spark: SparkSession, path, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(src_file, line_no, value)`` of xz files, blank lines included, 0-based numbers.

    The number of lines of each split, counted where it is read, gives those before the next one: lines
    are not shuffled, but blocks are decompressed once to count and once to read.
    """
    lines = xz_splits(spark, path, split_bytes).mapInArrow(
        _read, "src_file string, split int, pos bigint, value string"
    )
    counts = lines.groupBy("src_file", "split").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("src_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("src_file", "split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(starts, ["src_file", "split"]).select(
        "src_file", (F.col("pos") + F.col("_before")).alias("line_no"), "value"
    )
