"""Registered queries of the token stage."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from linkloom.functions import strings as S
from linkloom.operators import numbering, packing, stats, tokens as K
from linkloom.operators.pages import min_paragraph_words
from linkloom.plans import corpus
from linkloom.plans.link_queries import table
from linkloom.session import shared_folder
from linkloom.sinks import reports

BATCH, LIMIT = 64, 3000


def documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


def gapped(spark, d):
    """Documents with some line ends doubled, for the tables hold no blank line."""
    text = F.concat(F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n\n")), F.lit("\nz"))
    return documents(spark, d).withColumn("text", text)


PIECES_SQL = r"""
SELECT doc_id, i - 1 AS line_no, line, length(line) + CASE WHEN i < n THEN 1 ELSE 0 END AS width
FROM (SELECT doc_id, len(l) AS n, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line
      FROM (SELECT doc_id, string_split(replace(text, E'.\n', E'.\n\n') || E'\nz', E'\n') AS l
            FROM documents))
"""
# Written out for RE2, whose own white space is ASCII: words with their marks, or one other character
# that is no white space of Unicode.
WORD_SQL = (
    r"'[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\x09-\x0d\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'"
)
TOKENS_SQL = f"regexp_extract_all(line, {WORD_SQL})"


def word_count(spark, d):
    return documents(spark, d).select("doc_id", S.word_count(F.col("text")).alias("n_words"))


def nonblank_lines(spark, d):
    return K.nonblank_lines(gapped(spark, d))


def long_lines(spark, d):
    """Lines of four or more pieces, by the paragraph rule."""
    return min_paragraph_words(nonblank_lines(spark, d), 4, "line").select("doc_id", "line_no")


def blank_line_stats(spark, d):
    return stats.blank_line_stats(gapped(spark, d), "doc_id")


def tokenize_words(spark, d):
    return K.tokenize(gapped(spark, d))


# --- sub-words -----------------------------------------------------------------------------

# Merges handed in by the query, best first, in the printable byte alphabet (Ġ is a space);
# the vocabulary is the 256 bytes and then the merged symbols.
MERGES = (
    ("t", "h"), ("Ġ", "th"), ("e", "r"), ("o", "n"), ("a", "n"), ("i", "n"), ("Ġth", "e"),
    ("in", "g"), ("Ġ", "a"), ("an", "d"), ("Ġ", "an"), ("s", "t"), ("er", "e"),
)
EOT = 256 + len(MERGES)


def encoder_tables(spark):
    left, right = zip(*MERGES)
    merges = pa.table({"rank": range(len(MERGES)), "left": left, "right": right})
    symbols = [*K.byte_alphabet(), *(a + b for a, b in MERGES)]
    vocab = pa.table({"token": symbols, "id": range(len(symbols))})
    return spark.createDataFrame(vocab), spark.createDataFrame(merges)


def encoded(spark, d):
    vocab, merges = encoder_tables(spark)
    return K.tokenize(documents(spark, d), "subwords", vocab=vocab, merges=merges, eot=EOT)


def encode_subwords(spark, d):
    kept = K.min_tokens(encoded(spark, d))
    return kept.select("doc_id", "n_tokens", F.md5(F.array_join("ids", " ")).alias("ids_md5"))


def unknown_symbols(spark, d):
    """With a vocabulary that lacks two bytes: what is left, and what is missing."""
    vocab, merges = encoder_tables(spark)
    found = K.encode_subwords(documents(spark, d), vocab.where("token not in ('b', '.')"), merges)
    ids = F.md5(F.array_join("ids", " "))
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), ids.alias("ids_md5"), "n_unknown")


def shard_content(spark, d):
    """Encoded ids, packed: the documents of each shard in order, with their ids."""
    path = F.format_string("parsed/%07d.txt", "doc_id").alias("path")
    rows = encoded(spark, d).select(path, "ids", "n_tokens")
    packed = K.pack_tokens(rows, LIMIT, batch_size=BATCH)
    ids = F.md5(F.array_join("ids", " "))
    return K.shard_rows(rows, packed).select("batch_id", "shard_id", "pos", ids.alias("ids_md5"))


def _encode_sql() -> str:
    """Each merge, in order, as a replacement on the text's marked bytes.

    This equals best-pair-first merging because every merge is built from earlier ones, and
    word cuts never part a mergeable pair in texts without apostrophes.
    """
    code = {s: f"{b:02X}" for b, s in enumerate(K.byte_alphabet())}
    text = "regexp_replace(hex(encode(text)), '(..)', '<\\1>', 'g')"
    for a, b in MERGES:
        code[a + b] = code[a] + code[b]
        text = f"replace({text}, '<{code[a]}><{code[b]}>', '<{code[a + b]}>')"
    cases = " ".join(
        f"WHEN '{code[a + b]}' THEN {256 + i}" for i, (a, b) in enumerate(MERGES)
    )
    one = f"CASE s {cases} ELSE CAST('0x' || s AS INTEGER) END"
    return f"""
    SELECT doc_id, list_append([{one} FOR s IN regexp_extract_all(marked, '<([0-9A-F]+)>', 1)], {EOT}) AS ids
    FROM (SELECT doc_id, {text} AS marked FROM documents)
    """


# --- packing -------------------------------------------------------------------------------


def lengths(spark, d):
    """Word tokens and the end marker of each document, under the name of its file."""
    path = F.format_string("parsed/%07d.txt", "doc_id")
    n = F.size(K.word_tokens(F.col("text"))) + 1
    return documents(spark, d).select(path.alias("path"), n.cast("bigint").alias("n_tokens"))


def batch_files(spark, d):
    return numbering.batch_files(lengths(spark, d).select("path"), BATCH, digits=2)


def pack_tokens(spark, d):
    return K.pack_tokens(lengths(spark, d), LIMIT, batch_size=BATCH).select(
        "batch_id", "shard_id", "path", "n_tokens"
    )


def pack_far(spark, d):
    """Two batches, each of half the documents, whose shards are found by pointers."""
    pos = F.substring("path", 8, 7).cast("bigint")
    halves = lengths(spark, d).withColumns({"pos": pos, "batch_id": pos % 2})
    return packing.pack_far(K.min_tokens(halves), LIMIT, rows=100).select("batch_id", "shard_id", "path", "n_tokens")


def token_corpus(spark, d):
    return corpus.token_corpus(lengths(spark, d), LIMIT, batch_size=BATCH)


def token_report(spark, d):
    return stats.token_report(lengths(spark, d), 60)


def write_encoded(spark, d):
    """The same report, counted by the job that writes the documents, and the rows that it wrote."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    report = reports.write_encoded(lengths(spark, d), folder, 60)
    found = spark.read.parquet(folder).agg(F.count("*").alias("n_written"), F.sum("n_tokens").alias("n_tokens"))
    return found.withColumns({name: F.lit(n).cast("bigint") for name, n in report.items()})


LENGTHS_SQL = f"""
SELECT printf('parsed/%07d.txt', doc_id) AS path,
  len(regexp_extract_all(text, {WORD_SQL})) + 1 AS n_tokens FROM documents
"""
def batched_sql(lengths: str) -> str:
    return f"""
SELECT path, n_tokens, r // {BATCH} AS batch_id, r % {BATCH} AS pos
FROM (SELECT *, row_number() OVER (ORDER BY md5(path), path) - 1 AS r FROM ({lengths}))
"""


def packed_sql(batched: str) -> str:
    return f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY pos) AS r
  FROM ({batched}) WHERE n_tokens >= 20),
fold AS (
  SELECT batch_id, r, pos, path, n_tokens, n_tokens AS filled, 0 AS shard_id FROM docs WHERE r = 1
  UNION ALL
  SELECT n.batch_id, n.r, n.pos, n.path, n.n_tokens,
    CASE WHEN f.filled > {LIMIT} THEN n.n_tokens ELSE f.filled + n.n_tokens END,
    CASE WHEN f.filled > {LIMIT} THEN f.shard_id + 1 ELSE f.shard_id END
  FROM fold f JOIN docs n ON n.batch_id = f.batch_id AND n.r = f.r + 1)
SELECT batch_id, CAST(shard_id AS BIGINT) AS shard_id, pos, path, n_tokens FROM fold
"""


BATCHED_SQL = batched_sql(LENGTHS_SQL)
PACKED_SQL = packed_sql(BATCHED_SQL)
HALVES_SQL = f"SELECT *, CAST(substr(path, 8, 7) AS BIGINT) AS pos, pos % 2 AS batch_id FROM ({LENGTHS_SQL})"
ENCODED_SQL = f"SELECT printf('parsed/%07d.txt', doc_id) AS path, ids, len(ids) AS n_tokens FROM ({_encode_sql()})"
SHARDS_SQL = f"""
SELECT batch_id, shard_id, pos, md5(array_to_string(ids, ' ')) AS ids_md5
FROM ({packed_sql(batched_sql(ENCODED_SQL))}) JOIN ({ENCODED_SQL}) USING (path)
"""

QUERIES = {
    "word_count": (
        word_count,
        r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS n_words FROM documents",
    ),
    "nonblank_lines": (
        nonblank_lines, f"SELECT doc_id, line_no, line FROM ({PIECES_SQL}) WHERE width > 1"
    ),
    "long_lines": (
        long_lines,
        f"""SELECT doc_id, line_no FROM ({PIECES_SQL})
            WHERE width > 1 AND len(string_split(line, ' ')) >= 4""",
    ),
    "blank_line_stats": (
        blank_line_stats,
        f"""SELECT doc_id, count(*) AS n_lines, count(*) FILTER (width <= 1) AS n_blank
            FROM ({PIECES_SQL}) WHERE width > 0 GROUP BY doc_id""",
    ),
    "tokenize_words": (
        tokenize_words,
        f"""SELECT doc_id, line_no, array_to_string({TOKENS_SQL}, ' ') AS tokens
            FROM ({PIECES_SQL}) WHERE width > 1""",
    ),
    "encode_subwords": (
        encode_subwords,
        f"""SELECT doc_id, len(ids) AS n_tokens, md5(array_to_string(ids, ' ')) AS ids_md5
            FROM ({_encode_sql()}) WHERE len(ids) >= 20""",
    ),
    "unknown_symbols": (
        unknown_symbols,
        f"""SELECT doc_id, len(known) AS n_ids, md5(array_to_string(known, ' ')) AS ids_md5,
              len(ids) - 1 - len(known) AS n_unknown
            FROM (SELECT doc_id, ids,
                    list_filter(ids, lambda i: i NOT IN ({ord('b')}, {ord('.')}, {EOT})) AS known
                  FROM ({_encode_sql()}))""",
    ),
    "shard_content": (shard_content, SHARDS_SQL),
    "batch_files": (batch_files, f"SELECT path, batch_id, pos FROM ({BATCHED_SQL})"),
    "pack_tokens": (pack_tokens, f"SELECT batch_id, shard_id, path, n_tokens FROM ({PACKED_SQL})"),
    "pack_far": (pack_far, f"SELECT batch_id, shard_id, path, n_tokens FROM ({packed_sql(HALVES_SQL)})"),
    "token_corpus": (
        token_corpus,
        f"""SELECT batch_id, shard_id, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens
            FROM ({PACKED_SQL}) GROUP BY ALL""",
    ),
    "write_encoded": (
        write_encoded,
        f"""SELECT count(*) FILTER (n_tokens < 60) AS n_omitted, count(*) AS n_total, count(*) AS n_written,
              CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM ({LENGTHS_SQL})""",
    ),
    "token_report": (
        token_report,
        f"""SELECT count(*) FILTER (n_tokens < 60) AS n_omitted, count(*) AS n_total
            FROM ({LENGTHS_SQL})""",
    ),
}
