"""Token stage: word lines, sub-word ids, end markers, length filter and packing."""

from __future__ import annotations

from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.strings import lines_of
from linkloom.operators.numbering import batch_files

# A word, or one mark that is neither letter, digit nor space (rule of this library).
# Letters carry their marks, as NFKD splits an accented letter in two.
WORD = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"
# Pre-token pattern of the public 50k byte-level vocabulary (fixed value).
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Defaults (fixed values): shortest document, shard limit, files per batch.
MIN_LENGTH = 20
COMBINE = 100_000_000
FILES_PER_BATCH = 10_000

# Bytes that vocabulary and merges may take in each Python worker.
VOCAB_BYTES = 1 << 30
# Stands for a symbol without an id until it is counted.
UNKNOWN = -(2**31)
# Symbols up to which a word is merged by plain search.
SHORT_WORD = 24
# Words a worker remembers, and the longest it remembers.
CACHED_WORDS, CACHED_LENGTH = 500_000, 64
_coded: dict[str, dict[str, list[int]]] = {}


def _words_of(vocabulary: str) -> dict[str, list[int]]:
    """What this worker has encoded with a vocabulary; it keeps one, over all its tasks."""
    if vocabulary not in _coded:
        _coded.clear()
        _coded[vocabulary] = {}
    return _coded[vocabulary]


def nonblank_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per kept line, numbered from 0 with the blank ones counted."""
    rest = [c for c in docs.columns if c != text]
    kept = F.filter(lines_of(F.col(text)), lambda x: x["kept"])
    return docs.select(*rest, F.inline(kept)).drop("kept")


def word_tokens(text: Column) -> Column:
    """Words and marks; white space is that of Unicode."""
    return F.regexp_extract_all(text, F.lit("(?U)" + WORD), 0)


def tokenize_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Non-blank lines as word tokens joined by single spaces."""
    lines = nonblank_lines(docs, text)
    rest = [c for c in lines.columns if c != "line"]
    return lines.select(*rest, F.array_join(word_tokens(F.col("line")), " ").alias("tokens"))


def _lookup(vocab: DataFrame, merges: DataFrame) -> tuple[dict, dict]:
    """Both tables as dictionaries, after a check of the room they take.

    Every worker holds them whole, whatever their number of rows, so there is no other way beyond
    ``VOCAB_BYTES``: about eight million rows of usual length.
    """
    # A dictionary entry with its string objects takes some 120 bytes beside the characters.
    held = vocab.agg(F.sum(F.octet_length("token") + 120)).first()[0] or 0
    held += merges.agg(F.sum(F.octet_length("left") + F.octet_length("right") + 240)).first()[0] or 0
    if held > VOCAB_BYTES:
        raise ValueError(f"vocabulary and merges take {held} bytes of {VOCAB_BYTES} in each worker")
    tokens = vocab.select("token", "id").collect()
    pairs = merges.select("left", "right", "rank").collect()
    return {r.token: r.id for r in tokens}, {(r.left, r.right): r.rank for r in pairs}


def encode_subwords(
    docs: DataFrame, vocab: DataFrame, merges: DataFrame, text: str = "text"
) -> DataFrame:
    """Add ``ids``: byte-level sub-word ids by the given ``vocab(token, id)`` and
    ``merges(rank, left, right)``, whose rows are written in the printable byte alphabet; and
    ``n_unknown``: how many symbols the vocabulary has no id for.  These have no place in ``ids``,
    so a document with any is not complete.

    The text is cut into words in the JVM.  Each Arrow batch is dictionary-encoded, so a word
    is merged once per batch however often it occurs, and a bounded cache carries frequent
    words over batches.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_lookup(vocab, merges))
    vocabulary = uuid4().hex

    @F.arrow_udf("ids array<int>, n_unknown bigint")
    def encode(batch: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow.compute as pc

        def ends(lengths):
            return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])

        ids, ranks = shared.value
        known = _words_of(vocabulary)
        alphabet = byte_alphabet()
        words = batch.flatten().dictionary_encode()
        per_word = []
        for word in words.dictionary.to_pylist():
            code = known.get(word)
            if code is None:
                symbols = merge_symbols([alphabet[b] for b in word.encode("utf-8")], ranks)
                code = [ids.get(s, UNKNOWN) for s in symbols]
                if len(known) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
                    known[word] = code
            per_word.append(code)
        coded = pa.array(per_word, pa.list_(pa.int32())).take(words.indices)
        # Ends of the documents, first in words and then in symbols; then those without an id go.
        word_ends = ends(pc.fill_null(batch.value_lengths(), 0))
        symbol_ends = ends(coded.value_lengths())[word_ends]
        flat = coded.flatten()
        gone = np.concatenate([[0], np.cumsum(flat.to_numpy(zero_copy_only=False) == UNKNOWN)])
        n_unknown = np.diff(gone[symbol_ends])
        if gone[-1]:
            flat = flat.filter(pc.not_equal(flat, UNKNOWN))
        offsets = pa.array(symbol_ends - gone[symbol_ends], pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, flat, mask=batch.is_null()),
                pa.array(n_unknown, pa.int64(), mask=batch.is_null().to_numpy(zero_copy_only=False)),
            ],
            ["ids", "n_unknown"],
        )

    words = F.regexp_extract_all(F.col(text), F.lit("(?U)" + PRE_TOKEN), 0)
    coded = docs.withColumn("_coded", encode.asNondeterministic()(words))
    return coded.withColumns({"ids": F.col("_coded.ids"), "n_unknown": F.col("_coded.n_unknown")}).drop(
        "_coded"
    )


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself if visible, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    shift = {b: 256 + n for n, b in enumerate(hidden)}
    return [chr(shift.get(b, b)) for b in range(256)]


def merge_symbols(symbols: list[str], ranks: dict) -> list[str]:
    """Join the best-ranked neighbours, everywhere, until no pair has a rank."""
    if len(symbols) > SHORT_WORD:
        return _merge_long(symbols, ranks)
    while True:
        best = rank = None
        for pair in zip(symbols, symbols[1:]):
            found = ranks.get(pair)
            if found is not None and (rank is None or found < rank):
                best, rank = pair, found
        if best is None:
            return symbols
        merged, i = [], 0
        while i < len(symbols):
            if symbols[i] == best[0] and symbols[i + 1 : i + 2] == [best[1]]:
                merged.append(symbols[i] + best[1])
                i += 2
            else:
                merged.append(symbols[i])
                i += 1
        symbols = merged


def _merge_long(symbols: list[str], ranks: dict) -> list[str]:
    """The same with a heap of ranked pairs over linked places: near linear in the word."""
    from heapq import heapify, heappop, heappush

    size = len(symbols)
    parts, after, before = list(symbols), list(range(1, size + 1)), list(range(-1, size - 1))

    def pair_at(i):
        j = after[i] if i >= 0 else size
        if j >= size:
            return None
        rank = ranks.get((parts[i], parts[j]))
        return None if rank is None else (rank, i, parts[i], parts[j])

    heap = [p for p in map(pair_at, range(size)) if p]
    heapify(heap)
    while heap:
        round_rank, fresh = heap[0][0], []
        while heap and heap[0][0] == round_rank:
            _, i, left, right = heappop(heap)
            j = after[i]
            if parts[i] != left or j >= size or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, None, after[j]
            if after[i] < size:
                before[after[i]] = i
            fresh += [p for p in (pair_at(before[i]), pair_at(i)) if p]
        for pair in fresh:
            heappush(heap, pair)
    return [p for p in parts if p is not None]


def append_eot(df: DataFrame, eot: int, ids: str = "ids") -> DataFrame:
    """End-of-text id behind each document, so that documents can be joined."""
    return df.withColumn(ids, F.concat(F.col(ids), F.array(F.lit(eot).cast("int"))))


def with_lengths(df: DataFrame, ids: str = "ids") -> DataFrame:
    return df.withColumn("n_tokens", F.size(ids).cast("bigint"))


def min_tokens(df: DataFrame, n: int = MIN_LENGTH, length: str = "n_tokens") -> DataFrame:
    """Drop documents under ``n`` tokens, end marker included."""
    return df.filter(F.col(length) >= n)


def pack(
    lengths: DataFrame,
    limit: int = COMBINE,
    by: str = "batch_id",
    order: str = "pos",
    length: str = "n_tokens",
) -> DataFrame:
    """Add ``shard_id``: documents fill a shard until it *exceeds* ``limit``; the next starts
    empty.  Sequential inside a batch by definition, so batches must be bounded (see
    ``batch_files``).  Pass names and lengths only: token arrays have no place here.
    """
    schema = T.StructType([*lengths.schema, T.StructField("shard_id", T.LongType())])

    def close_shards(batch):
        import numpy as np

        batch = batch.sort_values(order)
        total = batch[length].to_numpy().cumsum()
        shard = np.zeros(len(batch), dtype="int64")
        start, filled, number = 0, 0, 0
        while start < len(batch):
            # The first document that takes the shard past its limit is its last one.
            end = int(np.searchsorted(total, filled + limit, side="right")) + 1
            shard[start:end] = number
            filled = total[min(end, len(batch)) - 1]
            start, number = end, number + 1
        return batch.assign(shard_id=shard)

    return lengths.groupBy(by).applyInPandas(close_shards, schema)


def pack_tokens(
    encoded: DataFrame,
    combine: int = COMBINE,
    min_length: int = MIN_LENGTH,
    batch_size: int = FILES_PER_BATCH,
    path: str = "path",
) -> DataFrame:
    """Batch the files, drop short documents and assign shards.

    ``encoded`` holds ``path`` and ``n_tokens`` (end marker counted) and perhaps ``ids``.  The
    result has one row per kept document, ``(batch_id, shard_id, pos, path, n_tokens)``: a
    shard is its documents in order of ``pos``.  Written tables are read for those two columns
    only; ``shard_rows`` joins the ids on afterwards.
    """
    batched = batch_files(encoded.select(path, "n_tokens"), batch_size, path)
    kept = min_tokens(batched, min_length)
    return pack(kept, combine).select("batch_id", "shard_id", "pos", path, "n_tokens")


def shard_rows(encoded: DataFrame, packed: DataFrame, path: str = "path") -> DataFrame:
    """Shard content as rows ``(batch_id, shard_id, pos, ids)``: no shard is one huge array."""
    return packed.select("batch_id", "shard_id", "pos", path).join(
        encoded.select(path, "ids"), path
    ).select("batch_id", "shard_id", "pos", "ids")


def encode_documents(
    docs: DataFrame, vocab: DataFrame, merges: DataFrame, eot: int, text: str = "text"
) -> DataFrame:
    """Ids with the end marker, and their number."""
    return with_lengths(append_eot(encode_subwords(docs, vocab, merges, text), eot))


TOKENIZERS = {"words": tokenize_words, "subwords": encode_documents}
# Names under which these modes are asked for elsewhere.
ALIASES = {"spacy": "words", "gpt2": "subwords"}


def tokenize(docs: DataFrame, mode: str = "words", **options) -> DataFrame:
    """Tokens by mode name; ``subwords`` needs ``vocab``, ``merges`` and ``eot``."""
    name = ALIASES.get(mode, mode)
    if name not in TOKENIZERS:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join((*TOKENIZERS, *ALIASES))}")
    return TOKENIZERS[name](docs, **options)
