"""Multi-block and multi-stream xz files: the same lines and numbers as from one task."""

import io
import lzma
import random
import shutil
import subprocess
import zlib

import pytest

from linkloom.sources import xz
from linkloom.sources.dumps import read_submission_lines


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def number(n):
    out = b""
    while n >= 0x80:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def one_stream(pieces, check=lzma.CHECK_CRC64):
    """A stream with a block for each piece, put together from streams of one block."""
    empty = lzma.compress(b"", check=check, preset=0)
    body, records, header, flags = b"", [], empty[:12], empty[-4:-2]
    for piece in filter(None, pieces):  # nothing makes no block
        stream = lzma.compress(piece, check=check, preset=0)
        header, flags = stream[:12], stream[-4:-2]
        ((start, _, size, length),) = xz.block_index(Source(stream))
        unpadded = size
        # The index tells the size without padding, which the one-block stream's index does as well.
        index_size = (int.from_bytes(stream[-8:-4], "little") + 1) * 4
        unpadded, _ = xz._number(stream[-12 - index_size : -12], 2)
        body += stream[start : start + size]
        records.append((unpadded, length))
    index = b"\0" + number(len(records)) + b"".join(number(a) + number(b) for a, b in records)
    index += b"\0" * (-len(index) % 4)
    index += zlib.crc32(index).to_bytes(4, "little")
    footer = (len(index) // 4 - 1).to_bytes(4, "little") + flags
    return header + body + index + zlib.crc32(footer).to_bytes(4, "little") + footer + b"YZ"


def cut(data, n, rng):
    places = sorted(rng.randrange(len(data) + 1) for _ in range(n - 1))
    return [data[a:b] for a, b in zip([0, *places], [*places, len(data)])]


def lines_of(spark, path, split_bytes=1):
    rows = sorted((r.line_no, r.value) for r in xz.read_xz_lines(spark, str(path), split_bytes).collect())
    assert [n for n, _ in rows] == list(range(len(rows)))
    return [v.encode() for _, v in rows]


def plain(data):
    return data.split(b"\n")[:-1] if data.endswith(b"\n") or not data else data.split(b"\n")


def test_index():
    data = one_stream([b"abc" * 100, b"", b"x" * 5000])
    assert lzma.decompress(data) == b"abc" * 100 + b"x" * 5000
    blocks = xz.block_index(Source(data))
    assert [b[3] for b in blocks] == [300, 5000]
    two = data + b"\0" * 8 + lzma.compress(b"tail")
    assert [b[3] for b in xz.block_index(Source(two))][-1] == 4
    for bad in (b"no xz file at all, but long enough to be one ", data[:-4], lzma.compress(b"x")[4:]):
        with pytest.raises(ValueError):
            xz.block_index(Source(bad))
    assert xz.block_index(Source(b"")) == [] and xz.block_index(Source(lzma.compress(b""))) == []


@pytest.mark.parametrize("ending", [b"", b"\n", b"\n\n"])
def test_blocks_are_read_apart(spark, tmp_path, ending):
    rng = random.Random(len(ending))
    data = b"\n".join(bytes(rng.choices(b"abc \r", k=rng.choice([0, 1, 5, 40]))) for _ in range(120)) + ending
    for k, n in enumerate((1, 2, 7, 60)):
        streams = [one_stream([p for p in cut(part, n, rng)]) for part in cut(data, 2, rng)]
        path = tmp_path / f"RS_2016-0{k + 1}.xz"
        path.write_bytes(streams[0] + b"\0" * 4 + streams[1])
        assert lines_of(spark, path) == plain(data)
        assert lines_of(spark, path, 500) == plain(data)


def test_cuts_at_line_ends(spark, tmp_path):
    path = tmp_path / "RS_2016-01.xz"
    path.write_bytes(one_stream([b"a\n", b"b\n", b"\n", b"long", b" line", b"\nd"]))
    assert lines_of(spark, path) == [b"a", b"b", b"", b"long line", b"d"]
    splits = xz.xz_splits(spark, str(path), 1)
    assert splits.count() == 6 and splits.rdd.getNumPartitions() == 6


def test_empty_and_several_files(spark, tmp_path):
    (tmp_path / "RS_2016-01.xz").write_bytes(lzma.compress(b""))
    (tmp_path / "RS_2016-02.xz").write_bytes(one_stream([b"1\n2", b"2\n3\n"]))
    paths = [str(tmp_path / f"RS_2016-0{m}.xz") for m in (1, 2)]
    rows = read_submission_lines(spark, paths).collect()
    assert sorted((r.src_file[-13:], r.line_no, r.value) for r in rows) == [
        ("RS_2016-02.xz", 0, "1"), ("RS_2016-02.xz", 1, "22"), ("RS_2016-02.xz", 2, "3")
    ]


@pytest.mark.skipif(not shutil.which("xz"), reason="no xz command")
def test_files_of_the_xz_command(spark, tmp_path):
    data = b"".join(b"%d some words of a line\n" % i for i in range(20000))
    path = tmp_path / "RS_2016-01"
    path.write_bytes(data)
    subprocess.run(["xz", "--block-size=65536", str(path)], check=True)
    assert len(xz.block_index(open_source(f"{path}.xz"))) > 5
    assert lines_of(spark, f"{path}.xz", 100_000) == plain(data)


def open_source(path):
    with open(path, "rb") as file:
        return Source(file.read())
