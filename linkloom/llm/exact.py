"""Exact dedup by grace hashing.

Records are dealt to buckets by a hash of their content, and each bucket is resolved with an
open-addressing table that compares complete contents.  A bucket's table has a fixed room: what does
not fit is written to the shared folder as spill files and dealt again by the hash of the next level,
until every bucket fits.  Before the first shuffle each map task collapses its own copies with the
same table, so that a content with a third of all rows sends one record per task.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import WHITE, rows_of_task, values, written

#: Bytes of content that a task's table holds (two tasks share an executor's Python memory).
TABLE_BYTES = 96 << 20
_FLUSH = 4096


class ContentTable:
    """Open addressing with linear probing; a match means equal hash and equal complete content."""

    def __init__(self, room: int):
        self.room, self.used = room, 0
        self.slots, self.hashes, self.contents = [-1] * 64, [], []

    def _slot(self, value: int, content: bytes | None) -> int:
        """The slot of the content, or the free one where it would go (always, if None)."""
        mask = len(self.slots) - 1
        at = value & mask
        while (j := self.slots[at]) >= 0:
            if content is not None and self.hashes[j] == value and self.contents[j] == content:
                break
            at = (at + 1) & mask
        return at

    def find_or_add(self, content: bytes) -> tuple[int, bool]:
        """(entry, is new); entry -1 if the content is not held and there is no room for it.

        A table that has refused once takes no more, so that a content is either held from its
        first record on or never.  The first content always fits.
        """
        value = xxhash.xxh64_intdigest(content)
        at = self._slot(value, content)
        if self.slots[at] >= 0:
            return self.slots[at], False
        if self.contents and self.used + len(content) > self.room:
            self.room = -1
            return -1, False
        self.slots[at] = len(self.contents)
        self.hashes.append(value)
        self.contents.append(content)
        self.used += len(content) + 200  # with the entry's own share
        if 2 * len(self.contents) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for j, h in enumerate(self.hashes):
                self.slots[self._slot(h, None)] = j
        return len(self.contents) - 1, True


def _better(a: tuple, b: tuple) -> bool:
    """(points, doc_id, uid): more code points, then the smaller doc_id, null last."""
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    return rank(a) < rank(b)


_COLLAPSED = (
    "uid long, doc_id long, cls long, content binary, n long, points long, best_id long, best_uid long"
)
_RESOLVED = (
    "cls long, keep_id long, keep_uid long, group_size long, text_sha256 string,"
    " content binary, n long, points long, best_id long, best_uid long"
)

_GROUP = ("cls", "keep_id", "keep_uid", "group_size", "text_sha256")


def _batches(rows: list[tuple], fields: list[tuple[str, pa.DataType]]):
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields]
    )


_LONG = pa.int64()
_COLLAPSED_FIELDS = [
    ("uid", _LONG), ("doc_id", _LONG), ("cls", _LONG), ("content", pa.binary()), ("n", _LONG),
    ("points", _LONG), ("best_id", _LONG), ("best_uid", _LONG),
]
_RESOLVED_FIELDS = [
    ("cls", _LONG), ("keep_id", _LONG), ("keep_uid", _LONG), ("group_size", _LONG),
    ("text_sha256", pa.string()), ("content", pa.binary()), ("n", _LONG), ("points", _LONG),
    ("best_id", _LONG), ("best_uid", _LONG),
]


def _in_pieces(rows, fields):
    """Batches of bounded size from a stream of rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= _FLUSH or size >= 16 << 20:
            yield _batches(held, fields)
            held, size = [], 0
    if held:
        yield _batches(held, fields)


def _collapse(room: int):
    """A member row for each document; a class row for each content that the task has seen."""

    def rows(batches):
        table, best, counts, uids = ContentTable(room), [], [], rows_of_task()
        for batch in batches:
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                text = text or ""
                uid, mine = next(uids), None
                content = text.encode().translate(None, WHITE)
                mine = (len(text), doc_id, uid)
                j, new = table.find_or_add(content)
                if j < 0:  # no room: a class of its own, united with its copies in its bucket
                    yield (uid, doc_id, uid, None, None, None, None, None)
                    yield (None, None, uid, content, 1, *mine)
                    continue
                if new:
                    best.append(mine)
                    counts.append([uid, 0])
                elif _better(mine, best[j]):
                    best[j] = mine
                counts[j][1] += 1
                yield (uid, doc_id, counts[j][0], None, None, None, None, None)
        for content, top, (cls, n) in zip(table.contents, best, counts):
            yield (None, None, cls, content, n, *top)

    return lambda batches: _in_pieces(rows(batches), _COLLAPSED_FIELDS)


def _bucket(room: int):
    """Resolve what the table holds; hand on, with its content, what it has no room for."""

    def rows(batches):
        from hashlib import sha256

        table, best, sizes, classes = ContentTable(room), [], [], []
        names = ("cls", "content", "n", "points", "best_id", "best_uid")
        for batch in batches:
            for cls, content, n, *top in zip(*(values(batch, x) for x in names)):
                j, new = table.find_or_add(content)
                if j < 0:
                    yield (cls, None, None, None, None, content, n, *top)
                    continue
                if new:
                    best.append(tuple(top))
                    sizes.append(0)
                    classes.append([])
                elif _better(tuple(top), best[j]):
                    best[j] = tuple(top)
                sizes[j] += n
                classes[j].append(cls)
        for content, top, n, own in zip(table.contents, best, sizes, classes):
            digest = sha256(content).hexdigest()
            for cls in own:
                yield (cls, top[1], top[2], n, digest, None, None, None, None, None)

    return lambda batches: _in_pieces(rows(batches), _RESOLVED_FIELDS)


def _dealt(pending: DataFrame, level: int, table_bytes: int) -> DataFrame | None:
    """``pending`` in buckets by the hash of its level, as many as its bytes need; None if it is empty.

    Buckets are cut for two thirds of a table, so that nearly all fit; what does not is dealt again at
    the next level, by another hash and into buckets of its own.
    """
    rows, held = pending.agg(F.count("*"), F.sum(F.octet_length("content") + 200)).first()
    if not rows:
        return None
    key = F.xxhash64(F.lit(level), "content")
    needed = min(rows, -(-3 * held // (2 * table_bytes)))
    if needed <= int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return pending.repartition(key)
    return pending.repartition(int(needed), key)


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The group of each document among documents with equal text, white space deleted.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.  The row
    with the most code points stays, then the one with the smallest ``doc_id`` (null is largest),
    then any one of fully equal rows, so that exactly one row of a group has ``kept``.  A null text
    counts as empty; all empty or blank texts are one group.  An empty table gives no rows.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    start = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    collapsed = written(start.mapInArrow(_collapse(table_bytes), _COLLAPSED))
    members = collapsed.where("content is null").select("uid", "doc_id", "cls")
    pending = collapsed.where("content is not null").drop("uid", "doc_id")
    resolved, level = [], 0
    while (dealt := _dealt(pending, level, table_bytes)) is not None:
        out = written(dealt.mapInArrow(_bucket(table_bytes), _RESOLVED))
        resolved.append(out.where("content is null").select(*_GROUP))
        pending = out.where("content is not null").select(
            "cls", "content", "n", "points", "best_id", "best_uid"
        )
        level += 1
    if not resolved:
        resolved = [collapsed.sparkSession.createDataFrame([], _RESOLVED).select(*_GROUP)]
    groups = reduce(DataFrame.unionByName, resolved)
    return members.join(groups, "cls").select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
        "text_sha256",
    )
