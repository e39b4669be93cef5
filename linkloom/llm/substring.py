"""Removal of repeated passages with difference-cover anchors.

A difference cover D modulo p holds, for every difference of two residues, a pair with that
difference.  Hashes are taken of the short windows (``window - p + 1`` words) at positions in D modulo
p only.  If the same ``window`` words stand at any two positions, some shift below p takes both
positions into D at once, so that both have the same short window there: the shared anchor.  Only
around anchors that different texts share, matches are extended: the complete windows that hold such
an anchor are hashed (128 bits) and compared by the smallest document they occur in.

No pairs are formed.  A task first compares what it has itself; rows that it can decide alone are
marked and dealt at random, and only one document's rows of each hash go to the common meeting place.
So a passage in a third of all documents sends each task's share of it, not all its occurrences.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import values, written

WINDOW = 50
#: Perfect difference sets: the fewest positions for their period (fixed values).
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18)}
#: Hashes that a task compares at once.
BLOCK = 1 << 20
_LAST = 2**63 - 1  # the place of a null doc_id: after all others


def period_for(window: int) -> int:
    """The longest period that leaves anchors of two fifths of the window."""
    return max(p for p in COVERS if 5 * (window - p + 1) >= 2 * window)


class Words:
    """The words of a text, joined by single spaces, with the bounds of each."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()
        self.n, self.line = len(words), b" ".join(words)
        gaps = np.flatnonzero(np.frombuffer(self.line, np.uint8) == 32)
        self.starts = np.concatenate([[0], gaps + 1])[: self.n]
        self.ends = np.concatenate([gaps, [len(self.line)]])[: self.n]

    def span(self, first: int, n: int) -> bytes:
        return self.line[self.starts[first] : self.ends[first + n - 1]]

    def hashes(self, firsts: np.ndarray, n: int, digest) -> list[int]:
        """The digest of the ``n`` words from each of the given places on."""
        line = self.line
        at = zip(self.starts[firsts].tolist(), self.ends[firsts + (n - 1)].tolist())
        return [digest(line[a:b]) for a, b in at]


def text_key(line: bytes) -> tuple[int, int]:
    """128 bits of a word sequence as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(line), ">i8").tolist())


def cover_positions(n_words: int, window: int, period: int) -> np.ndarray:
    """Where the anchors of a text of so many words start."""
    last = n_words - (window - period + 1)
    firsts = np.arange(0, max(0, last + 1), period)[:, None] + np.array(COVERS[period])[None, :]
    firsts = firsts.ravel()
    return firsts[firsts <= last]


def _scattered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pseudorandom longs, to deal out rows that need no meeting."""
    mixed = (a.view(np.uint64) ^ (b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return (mixed * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _groups(order_keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First rows of groups of equal keys (sorted input), and each row's group."""
    n = len(order_keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for key in order_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new), new.cumsum() - 1


def _table_rows(batches):
    for batch in batches:
        out = []
        for text in values(batch, "text"):
            w = Words(text)
            out.append((*text_key(w.line), w.n, sha256(w.line).digest()))
        k1, k2, n, digest = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
            ],
            ["oid", "k1", "k2", "n_words", "digest"],
        )


def _in_blocks(found, flush):
    """Run ``flush`` over bounded blocks of the tuples of arrays that ``found`` yields."""
    held, n = [], 0
    for part in found:
        held.append(part)
        n += len(part[0])
        if n >= BLOCK:
            yield flush([np.concatenate(c) for c in zip(*held)])
            held, n = [], 0
    if n:
        yield flush([np.concatenate(c) for c in zip(*held)])


def _meet_anchors(columns):
    """Sorted by anchor: rows of anchors that two texts of the block share are decided here.

    A decided row has the place -1 - at; one of them goes to the meeting place to tell the others.
    """
    anchor, key, at = columns
    order = np.argsort(anchor, kind="stable")
    anchor, key, at = anchor[order], key[order], at[order]
    first, group = _groups([anchor])
    shared = (np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first))[group]
    alone = shared.copy()
    alone[first] = False
    route = np.where(alone, _scattered(key, at), anchor)
    return pa.RecordBatch.from_arrays(
        [pa.array(route), pa.array(key), pa.array(np.where(shared, -1 - at, at))],
        ["route", "key", "at"],
    )


def _anchors(window: int, period: int):
    def found(batches):
        seen = set()
        for batch in batches:
            for text in values(batch, "text"):
                w = Words(text)
                key = text_key(w.line)
                if w.n < window or key in seen:  # a copy has nothing that the first one has not
                    continue
                seen.add(key)
                at = cover_positions(w.n, window, period)
                hashes = w.hashes(at, window - period + 1, xxhash.xxh3_64_intdigest)
                anchors = np.array(hashes, np.uint64).view(np.int64)
                yield anchors, np.full(len(at), key[0]), at

    return lambda batches: _in_blocks(found(batches), _meet_anchors)


def candidate_starts(anchors_at: np.ndarray, n_words: int, window: int, period: int) -> np.ndarray:
    """The starts of all windows that hold one of the anchors."""
    marks = np.zeros(n_words + 1, np.int64)
    anchors_at = anchors_at[anchors_at + (window - period + 1) <= n_words]
    np.add.at(marks, np.maximum(anchors_at - period + 1, 0), 1)
    np.add.at(marks, anchors_at + 1, -1)
    starts = np.flatnonzero(marks.cumsum() > 0)
    return starts[starts <= n_words - window]


def _meet_windows(columns):
    """Sorted by window and document: later documents' rows are decided here (start -1 - at)."""
    h1, h2, oid, key, at = columns
    order = np.lexsort((oid, h2, h1))
    h1, h2, oid, key, at = (c[order] for c in (h1, h2, oid, key, at))
    first, group = _groups([h1, h2])
    later = oid > oid[first][group]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.where(later, _scattered(h1 ^ oid, at), h1)), pa.array(np.where(later, at, h2)),
            pa.array(oid), pa.array(key), pa.array(np.where(later, -1 - at, at)),
        ],
        ["r1", "r2", "oid", "key", "at"],
    )


def _windows(window: int, period: int):
    def found(batches):
        for batch in batches:
            names = ("oid", "key", "text", "anchors")
            for oid, key, text, anchors in zip(*(values(batch, x) for x in names)):
                w = Words(text)
                if text_key(w.line)[0] != key:  # another text with the same doc_id
                    continue
                at = candidate_starts(np.array(anchors, np.int64), w.n, window, period)
                # In pieces, as a long text may be a candidate all over.
                for low in range(0, len(at), BLOCK):
                    part = at[low : low + BLOCK]
                    digests = b"".join(w.hashes(part, window, xxhash.xxh3_128_digest))
                    h = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
                    yield h[:, 0], h[:, 1], np.full(len(part), oid), np.full(len(part), key), part

    return lambda batches: _in_blocks(found(batches), _meet_windows)


def keep_words(text: str | None, starts: list[int], window: int) -> tuple[int, bytes]:
    """How many words the windows cover, and the other words joined by one space."""
    w = Words(text)
    marks = np.zeros(w.n + 1, np.int64)
    starts = np.array(starts, np.int64)
    starts = starts[starts + window <= w.n]
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    gone = marks.cumsum()[: w.n] > 0
    left = np.flatnonzero(~gone)
    at = zip(w.starts[left].tolist(), w.ends[left].tolist())
    return int(gone.sum()), b" ".join([w.line[a:b] for a, b in at])


def _cut(window: int, with_text: bool):
    def run(batches):
        for batch in batches:
            out = []
            names = ("oid", "key", "text", "starts")
            for oid, key, text, starts in zip(*(values(batch, x) for x in names)):
                if text_key(Words(text).line)[0] == key:
                    n, kept = keep_words(text, starts, window)
                    body = kept.decode() if with_text else None
                    out.append((oid, key, n, sha256(kept).digest(), body))
            oid, key, n, digest, body = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(oid, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(digest, pa.binary()), pa.array(body, pa.string()),
                ],
                ["oid", "k1", "n_cut", "cut_digest", "cut_text"],
            )

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``, one row per row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    ``doc_id``.  Windows are judged on the input.  Null and empty texts, and texts shorter than a
    window, keep all words.  A null ``doc_id`` is larger than all others; rows with equal ``doc_id``
    take nothing from each other.  Other columns are not read.  ``with_text`` adds ``kept_text``: the
    kept words where some but not all went, null where the text stays as it is or goes whole.
    """
    period = period_for(window)
    oid = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("oid")
    base = docs.select(oid, F.col("text"))
    rows = written(
        base.mapInArrow(_table_rows, "oid long, k1 long, k2 long, n_words long, digest binary")
    )
    # Equal word sequences: all but the first go whole, and only the first is looked at further.
    classes = written(rows.groupBy("k1", "k2").agg(F.min("oid").alias("first_oid")))

    anchors = base.select("text").mapInArrow(
        _anchors(window, period), "route long, key long, at long"
    )
    met = Window.partitionBy("route")
    shared = anchors.select(
        "key", "at", F.min("key").over(met).alias("low"), F.max("key").over(met).alias("high"),
        F.min("at").over(met).alias("told"),
    ).where("low != high or told < 0")
    place = F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at"))
    by_text = written(shared.groupBy("key").agg(F.collect_list(place).alias("anchors")))

    asked = classes.join(by_text, classes.k1 == by_text.key).select(
        F.col("first_oid").alias("oid"), "key", "anchors"
    )
    # The texts around shared anchors, written once for the two steps that read them.
    near = written(base.join(asked, "oid"))
    windows = near.mapInArrow(_windows(window, period), "r1 long, r2 long, oid long, key long, at long")
    same = Window.partitionBy("r1", "r2")
    taken = windows.select("oid", "key", "at", F.min("oid").over(same).alias("least")).where(
        "at < 0 or oid > least"
    )
    starts = taken.groupBy("oid", "key").agg(F.collect_list(place).alias("starts"))
    cut = written(
        near.drop("anchors").join(starts, ["oid", "key"]).mapInArrow(
            _cut(window, with_text),
            "oid long, k1 long, n_cut long, cut_digest binary, cut_text string",
        )
    ).dropDuplicates(["oid", "k1"])

    copy = (F.col("oid") > F.col("first_oid")) & (F.col("n_words") >= window)
    doc_id = F.when(F.col("oid") != _LAST, F.col("oid"))
    nothing = F.lit(bytearray(sha256(b"").digest()))
    digest = F.when(copy, nothing).otherwise(F.coalesce("cut_digest", "digest"))
    out = rows.join(classes, ["k1", "k2"]).join(cut, ["oid", "k1"], "left").select(
        doc_id.alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(digest)).alias("kept_sha256"),
        *([F.when(~copy, F.col("cut_text")).alias("kept_text")] if with_text else []),
    )
    return out
