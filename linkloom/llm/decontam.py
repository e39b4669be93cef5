"""Benchmark decontamination: a broadcast hash set of word n-grams, and a scan of token windows.

Windows are kept as their normalised words, so that a hit compares the whole window and needs no
second look.  The set is broadcast in slices of a bounded size, one for any usual benchmark; a larger
one takes more passes over the documents, each with its own slice, and gives the same result.
"""

from __future__ import annotations

import math
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import values, written

WINDOW = 10
#: Bytes of windows in one broadcast, with the room that Python takes for each.
SLICE_BYTES, ENTRY_BYTES = 64 << 20, 300

# Word bytes of UTF-8: digits, letters, and all of characters beyond ASCII.
_TABLE = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _item_windows(window: int):
    def run(batches):
        for batch in batches:
            grams, items = [], []
            for item, text in zip(values(batch, "item_id"), values(batch, "text")):
                words = words_of(text)
                n = min(window, len(words))
                own = {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else ()
                grams += own
                items += [item] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.binary()), pa.array(items, pa.string())], ["gram", "item"]
            )

    return run


def find_spans(words: list[bytes], grams: dict, lengths: list[int]) -> tuple[list[int], set]:
    """Bounds of the hit word ranges (start, end, start, end ...), and the items."""
    line = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    ends = [*ends.tolist(), len(line)]
    hits = []
    for n in lengths:
        if words and len(words) >= n:
            span = zip(starts, ends[n - 1 :])
            hits += [(i, i + n, own) for i, (a, b) in enumerate(span) if (own := grams.get(line[a:b]))]
    items = set().union(*(own for *_, own in hits))
    return merged([bound for a, b, _ in hits for bound in (a, b)]), items


def merged(bounds: list[int]) -> list[int]:
    """Ranges as a sorted list of disjoint ones."""
    out: list[int] = []
    for a, b in sorted(zip(bounds[::2], bounds[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scan(grams, lengths):
    """Add what one slice of the set finds to what earlier ones found."""

    def run(batches):
        table = grams.value
        for batch in batches:
            n_words, spans, items = [], [], []
            old_spans, old_items = values(batch, "__spans"), values(batch, "__items")
            for text, before, named in zip(values(batch, "text"), old_spans, old_items):
                words = words_of(text)
                found, own = find_spans(words, table, lengths)
                n_words.append(len(words))
                spans.append(merged(before + found))
                # A null item id hits, but has no name to be listed.
                items.append(sorted(x for x in own.union(named) if x is not None))
            kept = [batch.column(i) for i in range(batch.num_columns - 3)]
            new = [
                pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*kept, *new], batch.schema.names)

    return run


def scan_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, the hit word ranges ``__spans`` and the ``__items`` found."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string"), "text")
    grams = items.mapInArrow(_item_windows(window), "gram binary, item string").distinct()
    grams = written(grams)
    size = grams.agg(F.sum(F.length("gram") + ENTRY_BYTES)).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    out = docs.select(
        "*", F.lit(0).cast("long").alias("__n_words"), F.array().cast("array<long>").alias("__spans"),
        F.array().cast("array<string>").alias("__items"),
    )
    for k in range(slices):
        own: dict[bytes, set] = {}
        part = grams.where(F.pmod(F.xxhash64("gram"), F.lit(slices)) == k)  # slice_bytes, about
        for gram, item in part.collect():
            own.setdefault(bytes(gram), set()).add(item)
        lengths = sorted({gram.count(b" ") + 1 for gram in own})
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(own), lengths), out.schema)
        if k + 1 < slices:
            out = written(out)
    return out


def _report(batches):
    for batch in batches:
        rows = list(zip(values(batch, "__n_words"), values(batch, "__spans"), values(batch, "__items")))
        n_hit = [sum(s[1::2]) - sum(s[::2]) for _, s, _ in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                pa.array(n_hit, pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([sha256(",".join(r[2]).encode()).hexdigest() for r in rows], pa.string()),
                pa.array([n > 0 for n in n_hit], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, one row per row of ``docs``.

    A word is hit if a window of an item (``window`` words; a shorter item whole) covers it.  Null and
    empty texts have no words and are clean; items without words have no window.  Repeated items and
    windows shared by items count once per item id; a null item id hits but is not named.  An empty
    benchmark leaves every document clean.
    """
    start = docs.select(F.col("doc_id").cast("long"), "text")
    found = scan_windows(start, benchmark, window, slice_bytes)
    return found.select("doc_id", "__n_words", "__spans", "__items").mapInArrow(
        _report,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def cut_words(text: str, spans: list[int]) -> str:
    """The text without the words of the ranges and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, done = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def _cut(batches):
    for batch in batches:
        texts = [
            cut_words(t, s) if s else t for t, s in zip(values(batch, "text"), values(batch, "__spans"))
        ]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                  window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit words.

    All columns of ``docs`` are kept as they are; see ``contamination`` for what counts as a hit.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    found = scan_windows(docs, benchmark, window, slice_bytes)
    if remove == "documents":
        return found.where(F.size("__spans") == 0).select(*docs.columns)
    return found.mapInArrow(_cut, found.schema).select(*docs.columns)
