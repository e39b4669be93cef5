"""Removal of repeated byte strings with a suffix sort that compares by hashes.

Prefix polynomial hashes of a buffer give the hash of any of its substrings in constant time, so the
common extension of two suffixes is found by binary search on its length, and a comparison of suffixes
takes logarithmic time.  A mergesort with that comparison puts equal strings side by side, the earliest
first.  Neighbours are then compared byte by byte: this proves the order, and if a collision has spoilt
it, the sort is done again with another base.

Only suffixes that can match are sorted.  Anchors are picked by content (the least hash of the seeds in
each window), so equal windows hold the same anchor at the same place.  All windows of an anchor lie in
its context, the bytes that reach from it to either side.  Contexts that occur as a whole before are
decided by their digest; what is left are the contexts of anchors that stand in different surroundings:
where repeated passages begin, end or were edited.  Their windows are sorted, the contexts of an anchor in
one task.  Anchors with more contexts than a task should hold are sorted in blocks, and the windows that
no block decides meet by digest.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import values, written
from linkloom.session import has_at_most

WINDOW = 100
#: Bytes of an anchor; a window holds WINDOW - SEED + 1 places for one.
SEED = 64
#: An anchor with more different contexts is sorted in blocks.
MOST_CONTEXTS = 4096
#: Bytes hashed at once, rows compared and windows sorted at once in a task.
CHUNK, ROWS, WINDOWS = 1 << 20, 1 << 20, 1 << 18
#: Buckets of anchors for each partition of a shuffle, and ids of documents that are broadcast at most.
BUCKETS, MOST_IDS = 4, 5_000_000
_LAST = 2**63 - 1  # the place of a null doc_id: after all others


@lru_cache(maxsize=8)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n - 1 of an odd number and of its inverse modulo 2^64."""
    odd = int(np.random.default_rng(base).integers(2**62, 2**63)) * 2 + 1
    out = []
    for factor in (odd, pow(odd, -1, 2**64)):
        powers = np.full(n, factor, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return tuple(out)


class Prefixes:
    """Hashes of all substrings of a buffer."""

    def __init__(self, data: np.ndarray, base: int = 0):
        n = len(data)
        powers, self.inverse = _powers(1 << n.bit_length(), base)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, sizes) -> np.ndarray:
        return (self.sums[starts + sizes] - self.sums[starts]) * self.inverse[starts]


def _sliding(a: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (or the most) of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        a = least(a[:-span], a[span:])
        span *= 2
    rest = width - span
    return least(a[:-rest], a[rest:]) if rest else a


def anchors(data: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Where a seed has the least hash of all seeds of some window; equal least ones all count."""
    places, width = [], window - seed + 1
    for low in range(0, len(data) - window + 1, CHUNK):
        part = data[low : low + CHUNK + window - 1]
        hashes = Prefixes(part).of(np.arange(len(part) - seed + 1), seed)
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        edge = np.zeros(width - 1, np.uint64)
        least = np.concatenate([edge, _sliding(hashes, width, np.minimum), edge])
        places.append(low + np.flatnonzero(_sliding(least, width, np.maximum) == hashes))
    return np.unique(np.concatenate(places)) if places else np.empty(0, np.int64)


class Buffer:
    """Windows of several pieces of text, to be sorted as suffixes.

    ``pieces`` are (oid, key, start, bytes): the bytes stand in the text ``key`` of the document ``oid``
    from ``start`` on.  A window of a text that two pieces hold counts once.
    """

    def __init__(self, pieces: list[tuple], window: int):
        self.window = window
        self.data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        sizes = np.array([len(p[3]) for p in pieces], np.int64)
        counts = np.maximum(sizes - window + 1, 0)
        bases = np.concatenate([[0], sizes.cumsum()[:-1]])
        within = np.arange(counts.sum()) - np.repeat(counts.cumsum() - counts, counts)
        columns = [np.repeat(np.array([p[i] for p in pieces], np.int64), counts) for i in range(3)]
        oid, key, start = columns[0], columns[1], columns[2] + within
        at = np.repeat(bases, counts) + within
        # In the order of documents, so that a row's number tells which of equal windows is earlier.
        order = np.lexsort((start, key, oid))
        oid, key, start, at = oid[order], key[order], start[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (oid[1:] != oid[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1])
        self.oid, self.key, self.start, self.at = oid[new], key[new], start[new], at[new]

    def _less(self, prefixes: Prefixes, a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
        """Whether window ``a`` comes before ``b``; of equal ones the earlier.  ``known`` bytes agree."""
        i, j = self.at[a], self.at[b]
        low, high = np.full(len(a), known), np.full(len(a), self.window)
        for _ in range((self.window - known).bit_length()):
            middle = (low + high + 1) >> 1
            same = prefixes.of(i, middle) == prefixes.of(j, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        end = np.minimum(low, self.window - 1)
        return np.where(low >= self.window, a < b, self.data[i + end] < self.data[j + end])

    def _merged(self, prefixes: Prefixes, rows: np.ndarray, group: np.ndarray, known: int) -> np.ndarray:
        """``rows``, sorted within runs of equal ``group`` by merging runs of 1, 2, 4, ... rows.

        All merges of a level are done at once: the place of a row in the merged run is its place in its
        own run plus the number of smaller rows in the other, found by binary search.
        """
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(first, len(rows)))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        local = np.arange(len(rows)) - base
        width = 1
        while width < sizes.max(initial=0):
            run = local // width
            low = np.minimum((run ^ 1) * width, size)
            top, other = np.minimum(low + width, size), low.copy()
            busy = np.flatnonzero(other < top)
            low, top = low.copy(), top.copy()
            while len(busy):
                middle = (low[busy] + top[busy]) >> 1
                less = self._less(prefixes, rows[base[busy] + middle], rows[busy], known)
                low[busy] = np.where(less, middle + 1, low[busy])
                top[busy] = np.where(less, top[busy], middle)
                busy = busy[low[busy] < top[busy]]
            place = base + (run & ~1) * width + (local - run * width) + (low - other)
            merged = np.empty_like(rows)
            merged[place] = rows
            rows, width = merged, width * 2
        return rows

    def repeated(self) -> np.ndarray:
        """Rows of windows that equal an earlier one."""
        if not len(self.at):
            return np.empty(0, np.int64)
        known = min(8, self.window)
        heads = np.zeros(len(self.at), np.uint64)
        for k in range(known):
            heads = (heads << np.uint64(8)) | self.data[self.at + k].astype(np.uint64)
        rows = np.argsort(heads, kind="stable")
        base = 0
        while True:
            rows = self._merged(Prefixes(self.data, base), rows, heads[rows], known)
            proven, equal = self._neighbours(rows)
            if proven:
                return rows[1:][equal]
            base += 1  # a collision: sort again with other hashes

    def _neighbours(self, rows: np.ndarray) -> tuple[bool, np.ndarray]:
        """Whether the order holds byte by byte, and which rows equal the one before them."""
        equal = np.zeros(max(0, len(rows) - 1), bool)
        span = np.arange(self.window)
        for low in range(0, len(equal), 1 << 14):
            a, b = rows[:-1][low : low + (1 << 14)], rows[1:][low : low + (1 << 14)]
            left, right = self.data[self.at[a][:, None] + span], self.data[self.at[b][:, None] + span]
            apart = left != right
            end = apart.argmax(axis=1)
            own = ~apart.any(axis=1)
            line = np.arange(len(a))
            if not np.where(own, a < b, left[line, end] < right[line, end]).all():
                return False, equal
            equal[low : low + len(a)] = own
        return True, equal

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """The bytes that these windows cover: oid, key, start and size of each run."""
        rows = np.sort(rows)
        oid, key, start = self.oid[rows], self.key[rows], self.start[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (oid[1:] != oid[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(rows))[: len(first)] - 1
        return oid[first], key[first], start[first], start[last] - start[first] + self.window


def text_key(body: bytes) -> tuple[int, int]:
    """128 bits of a text as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(body), ">i8").tolist())


def _bodies(batch, *names):
    """The given columns of a batch row by row, the text as bytes."""
    for *rest, text in zip(*(values(batch, name) for name in (*names, "text"))):
        yield *rest, (text or "").encode()


def _texts(batches):
    for batch in batches:
        out = [(*text_key(b), len(b), sha256(b).digest()) for (b,) in _bodies(batch)]
        k1, k2, n, digest = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
             pa.array(n, pa.int64()), pa.array(digest, pa.binary())],
            ["doc_id", "oid", "k1", "k2", "n_bytes", "digest"],
        )


def _scattered(*columns: np.ndarray) -> np.ndarray:
    """Pseudorandom longs, to deal out rows that need no meeting."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _batch(names: str, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names.split())


# Of an anchor's hash, the high bits choose its bucket and 38 low bits are compared in it: a chance
# meeting makes an anchor a candidate that no window confirms.
_LOW_BITS, _HIGH_BITS = 32, 6
_PLAIN, _TOLD, _DECIDED = 0, 1, 2


def _packed(anchor: np.ndarray, flag: np.ndarray, doc: np.ndarray, at: np.ndarray, keys: np.ndarray) -> bytes:
    """Anchors of a bucket in some ten bytes each; ``doc`` numbers the texts, whose ``keys`` come once."""
    own, place = np.unique(doc, return_inverse=True)
    small = np.uint16 if len(own) <= 1 << 16 else np.uint32
    low = (anchor & np.uint64((1 << _LOW_BITS) - 1)).astype(np.uint32)
    high = (anchor >> np.uint64(_LOW_BITS) & np.uint64((1 << _HIGH_BITS) - 1)).astype(np.uint8)
    parts = np.array([len(at), len(own)], np.uint32), low, high | (flag.astype(np.uint8) << _HIGH_BITS)
    return b"".join(p.tobytes() for p in (*parts, at.astype(np.uint32), place.astype(small), keys[own]))


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    """Compared bits, flag, key and place of each anchor."""
    n, m = np.frombuffer(data, np.uint32, 2).tolist()
    small, at, out = np.uint16 if m <= 1 << 16 else np.uint32, 8, []
    for kind, count in ((np.uint32, n), (np.uint8, n), (np.uint32, n), (small, n), (np.int64, m)):
        out.append(np.frombuffer(data, kind, count, at))
        at += count * np.dtype(kind).itemsize
    low, high, place, doc, keys = out
    bits = low.astype(np.int64) | (high & ((1 << _HIGH_BITS) - 1)).astype(np.int64) << _LOW_BITS
    return bits, high >> _HIGH_BITS, keys[doc], place.astype(np.int64)


def _anchors(window: int, seed: int, buckets: int):
    """Anchors of all texts by bucket; those that two places of a block share are decided in the block.

    Of the decided ones one tells the others of the bucket, and the rest are dealt out at random.
    """

    def meet(found, keys):
        anchor, doc, at = (np.concatenate(c) for c in zip(*found))
        keys = np.array(keys, np.int64)
        order = np.lexsort((at, doc, anchor))
        anchor, doc, at = anchor[order], doc[order], at[order]
        new = _firsts(anchor)
        sizes = np.diff(np.append(np.flatnonzero(new), len(at)))
        shared = np.repeat(sizes > 1, sizes)
        flag = np.where(shared, np.where(new, _TOLD, _DECIDED), _PLAIN)
        route = np.where(flag == _DECIDED, _scattered(keys[doc], at).view(np.uint64), anchor)
        bucket = (route >> np.uint64(40)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(_firsts(bucket[order]))
        pieces = [
            _packed(anchor[o], flag[o], doc[o], at[o], keys) for o in np.split(order, first[1:])
        ]
        return _batch("bucket anchors", bucket[order][first].astype(np.int64), pa.array(pieces, pa.binary()))

    def run(batches):
        found, n, keys, seen = [], 0, [], set()
        for batch in batches:
            for (body,) in _bodies(batch):
                key = text_key(body)[0]
                if len(body) < window or key in seen:  # a copy has nothing that the first one has not
                    continue
                seen.add(key)
                at = anchors(np.frombuffer(body, np.uint8), window, seed)
                hashes = [xxhash.xxh3_64_intdigest(body[a : a + seed]) for a in at.tolist()]
                found.append((np.array(hashes, np.uint64), np.full(len(at), len(keys)), at))
                keys.append(key)
                n += len(at)
                if n >= ROWS:
                    yield meet(found, keys)
                    found, n, keys, seen = [], 0, [], set()
        if n:
            yield meet(found, keys)

    return run


def _shared(batches):
    """``key, at`` of the anchors that stand in two places; rows come sorted by bucket."""

    def meet(held):
        bits, flag, key, at = (np.concatenate(c) for c in zip(*map(_unpacked, held)))
        sent = flag == _DECIDED
        done_key, done_at = key[sent], at[sent]
        bits, flag, key, at = (c[~sent] for c in (bits, flag, key, at))
        order = np.lexsort((at, key, bits))
        bits, flag, key, at = (c[order] for c in (bits, flag, key, at))
        first = np.flatnonzero(_firsts(bits))
        last = np.append(first[1:], len(bits))[: len(first)] - 1
        apart = (key[first] != key[last]) | (at[first] != at[last])
        if len(first):
            apart |= np.maximum.reduceat(flag, first) == _TOLD
        shared = np.repeat(apart, last - first + 1)
        return _batch("key at", np.concatenate([done_key, key[shared]]), np.concatenate([done_at, at[shared]]))

    held, last = [], None
    for batch in batches:
        for bucket, data in zip(values(batch, "bucket"), values(batch, "anchors")):
            if held and bucket != last:
                yield meet(held)
                held = []
            held.append(data)
            last = bucket
    if held:
        yield meet(held)


def context_span(window: int, seed: int) -> int:
    """More than the bytes of any context, so that its start and size go into one number."""
    return 2 * window - seed + 1


def _contexts(window: int, seed: int):
    """The context of each shared anchor with its digest; later copies in a block are decided there.

    A decided row has the place -1 - place and is dealt out at random.
    """
    reach = window - seed
    span = context_span(window, seed)

    def meet(found):
        r1, r2, anchor, oid, key, start, size = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((start, key, oid, r2, r1))
        r1, r2, anchor, oid, key, start, size = (c[order] for c in (r1, r2, anchor, oid, key, start, size))
        head = np.maximum.accumulate(np.where(_firsts(r1, r2), np.arange(len(r1)), 0))
        later = (oid != oid[head]) | (key != key[head]) | (start != start[head])
        route = np.where(later, _scattered(r1 ^ oid, key, start), r1)
        place = start * span + size
        return _batch("r1 r2 anchor oid key place", route, r2, anchor, oid, key, np.where(later, -1 - place, place))

    def run(batches):
        found, n = [], 0
        for batch in batches:
            for oid, key, places, body in _bodies(batch, "oid", "key", "anchors"):
                if text_key(body)[0] != key:  # another text with the same doc_id
                    continue
                at = np.unique(np.array(places, np.int64))
                at = at[at + seed <= len(body)]
                for low in range(0, len(at), ROWS):
                    part = at[low : low + ROWS]
                    start, end = np.maximum(part - reach, 0), np.minimum(part + window, len(body))
                    bounds = zip(part.tolist(), start.tolist(), end.tolist())
                    # The place of the anchor goes into the digest: equal contexts have equal anchors.
                    digests = b"".join(xxhash.xxh3_128_digest(body[s:e], a - s) for a, s, e in bounds)
                    halves = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
                    own = [xxhash.xxh3_64_intdigest(body[a : a + seed]) for a in part.tolist()]
                    found.append((halves[:, 0], halves[:, 1], np.array(own, np.uint64).view(np.int64),
                                  np.full(len(part), oid), np.full(len(part), key), start, end - start))
                    n += len(part)
                    if n >= ROWS:
                        yield meet(found)
                        found, n = [], 0
        if n:
            yield meet(found)

    return run


_PIECE = "kind r1 oid key start size piece"
_CONTEXT, _OPEN, _RUN = 0, 1, 2


def _pieces(window: int):
    """Contexts that must be sorted.

    Those of ordinary anchors are passed on whole.  Those of anchors with very many are sorted here, in
    blocks: later windows are decided, and the first of each kind is passed on by its digest.
    """

    def sort(block):
        buffer = Buffer(block, window)
        later = buffer.repeated()
        oid, key, start, size = buffer.runs(later)
        yield _batch(_PIECE, np.full(len(oid), _RUN), _scattered(oid, key, start), oid, key, start, size,
                     pa.nulls(len(oid), pa.binary()))
        left = np.ones(len(buffer.at), bool)
        left[later] = False
        data, at = buffer.data.tobytes(), buffer.at[left].tolist()
        digests = [xxhash.xxh3_128_digest(data[a : a + window]) for a in at]
        route = np.array([xxhash.xxh3_64_intdigest(d) for d in digests], np.uint64).view(np.int64)
        yield _batch(_PIECE, np.full(len(at), _OPEN), route, buffer.oid[left], buffer.key[left],
                     buffer.start[left], np.full(len(at), window), pa.array(digests, pa.binary()))

    def run(batches):
        block, n = [], 0
        for batch in batches:
            for oid, key, contexts, body in _bodies(batch, "oid", "key", "contexts"):
                if text_key(body)[0] != key:
                    continue
                plain = []
                for c in contexts:
                    piece = body[c["start"] : c["start"] + c["size"]]
                    if c["crowded"]:
                        block.append((oid, key, c["start"], piece))
                        n += len(piece) - window + 1
                    else:
                        plain.append((_CONTEXT, c["anchor"], oid, key, c["start"], c["size"], piece))
                    if n >= WINDOWS:
                        yield from sort(block)
                        block, n = [], 0
                if plain:
                    columns = list(zip(*plain))
                    types = [pa.int64()] * 6 + [pa.binary()]
                    yield _batch(_PIECE, *(pa.array(c, t) for c, t in zip(columns, types)))
        if block:
            yield from sort(block)

    return run


def _sorted_groups(window: int):
    """Runs of bytes repeated within the contexts of an anchor; rows come sorted by anchor."""

    def sort(block):
        buffer = Buffer(block, window)
        return _batch("oid key start size", *buffer.runs(buffer.repeated()))

    def run(batches):
        block, n, last = [], 0, None
        for batch in batches:
            columns = (values(batch, c) for c in ("r1", "oid", "key", "start", "piece"))
            for anchor, oid, key, start, piece in zip(*columns):
                if n >= WINDOWS and anchor != last:
                    yield sort(block)
                    block, n = [], 0
                last = anchor
                block.append((oid, key, start, piece))
                n += len(piece) - window + 1
        if block:
            yield sort(block)

    return run


def kept_spans(n: int, runs: list[dict]) -> tuple[int, int, np.ndarray]:
    """Bytes covered by the runs, their maximal runs, and the mask of the bytes that stay."""
    marks = np.zeros(n + 1, np.int64)
    starts = np.array([r["start"] for r in runs], np.int64)
    ends = starts + np.array([r["size"] for r in runs], np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    gone = marks.cumsum()[:n] > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    return int(gone.sum()), int(begins.sum()), ~gone


def _cut(with_text: bool):
    def run(batches):
        for batch in batches:
            out = []
            for oid, key, runs, body in _bodies(batch, "oid", "key", "runs"):
                if text_key(body)[0] == key:
                    n, spans, stays = kept_spans(len(body), runs)
                    left = np.frombuffer(body, np.uint8)[stays].tobytes()
                    out.append((oid, key, n, spans, sha256(left).digest(), left if with_text else None))
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.binary()] * 2
            yield _batch("oid k1 n_cut n_cut_spans cut_digest cut_text", *(pa.array(c, t) for c, t in zip(columns, types)))

    return run


def repeated_bytes(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``docs``.

    A byte of a text in UTF-8 goes if a string of ``window`` bytes that covers it also starts earlier: in a
    document with a smaller ``doc_id``, or before in the same text.  Strings may overlap and are judged on
    the input; ``n_spans`` counts the maximal runs of bytes that go.  Null and empty texts, and texts
    shorter than ``window``, keep all.  A null ``doc_id`` counts as the largest long.  Of different texts
    with one ``doc_id`` that with the smaller digest is the earlier; rows that are equal in both are the
    same document and get the same result.  Other columns are not read.  ``seed`` must be less than
    ``window`` and changes no result.  ``with_text`` adds ``kept``: the kept bytes where some but not all
    went, null where the text stays as it is or goes whole.
    """
    oid = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("oid")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), oid, F.col("text").cast("string").alias("text"))
    rows = written(base.mapInArrow(
        _texts, "doc_id long, oid long, k1 long, k2 long, n_bytes long, digest binary"
    ))
    # Equal texts: all but the first go whole, and only the first is looked at further.
    classes = written(rows.groupBy("k1", "k2").agg(F.min("oid").alias("first_oid")))

    # A bucket is gathered in its task, so there are several for each part of a shuffle.
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = base.select("text").mapInArrow(_anchors(window, seed, buckets), "bucket long, anchors binary")
    met = found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared, "key long, at long")
    by_text = met.groupBy("key").agg(F.collect_set("at").alias("anchors"))
    asked = classes.join(by_text, classes.k1 == by_text.key).select(
        F.col("first_oid").alias("oid"), "key", "anchors"
    )
    asked = written(asked)
    texts, ids = base.drop("doc_id"), asked.select("oid").distinct()
    if has_at_most(ids, MOST_IDS):  # other texts then need no shuffle
        texts = texts.join(F.broadcast(ids), "oid", "left_semi")
    # The texts around shared anchors, written once for the steps that read them.
    near = written(texts.join(asked, "oid"))

    contexts = near.mapInArrow(
        _contexts(window, seed), "r1 long, r2 long, anchor long, oid long, key long, place long"
    )
    at, same = F.struct("oid", "key", "place"), Window.partitionBy("r1", "r2")
    place, span = F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")), context_span(window, seed)
    judged = written(contexts.withColumn("least", F.min(at).over(same)).select(
        "anchor", "oid", "key", F.floor(place / span).alias("start"), F.pmod(place, F.lit(span)).alias("size"),
        ((F.col("place") < 0) | (at > F.col("least"))).alias("later"),
    ))
    left = judged.where("not later")
    crowds = left.groupBy("anchor").count().where("count > 1")
    crowded = (F.col("count") > MOST_CONTEXTS).alias("crowded")
    edges = left.join(crowds, "anchor").groupBy("oid", "key").agg(
        F.collect_list(F.struct("anchor", "start", "size", crowded)).alias("contexts")
    )
    pieces = written(near.drop("anchors").join(edges, ["oid", "key"]).mapInArrow(
        _pieces(window), "kind long, r1 long, oid long, key long, start long, size long, piece binary"
    ))
    sorted_here = pieces.where(f"kind = {_CONTEXT}").repartition("r1").sortWithinPartitions("r1").mapInArrow(
        _sorted_groups(window), "oid long, key long, start long, size long"
    )
    row, meeting = F.struct("oid", "key", "start"), Window.partitionBy("r1", "piece")
    met_again = pieces.where(f"kind = {_OPEN}").withColumn("least", F.min(row).over(meeting)).where(row > F.col("least"))
    run = ("oid", "key", "start", "size")
    runs = judged.where("later").select(*run).unionByName(sorted_here).unionByName(met_again.select(*run))
    runs = runs.unionByName(pieces.where(f"kind = {_RUN}").select(*run))
    runs = runs.groupBy("oid", "key").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    cut = written(near.drop("anchors").join(runs, ["oid", "key"]).mapInArrow(
        _cut(with_text),
        "oid long, k1 long, n_cut long, n_cut_spans long, cut_digest binary, cut_text binary",
    )).dropDuplicates(["oid", "k1"])

    copy = (F.col("oid") > F.col("first_oid")) & (F.col("n_bytes") >= window)
    nothing = F.lit(bytearray(sha256(b"").digest()))
    digest = F.when(copy, nothing).otherwise(F.coalesce("cut_digest", "digest"))
    return rows.join(classes, ["k1", "k2"]).join(cut, ["oid", "k1"], "left").select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_cut_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.lower(F.hex(digest)).alias("kept_sha256"),
        *([F.when(~copy, F.col("cut_text")).alias("kept")] if with_text else []),
    )
