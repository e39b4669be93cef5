"""The three entry points: links, pages and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions.strings import doc_fid, year_month
from linkloom.operators.dedup import dedupe_urls, keep_first, split_unparsable
from linkloom.functions.urls import with_url_key
from linkloom.operators.links import good_links, parse_submissions
from linkloom.operators.numbering import BUCKET_ROWS, assign_chunks
from linkloom.operators.pages import extract_all, main_text, nonempty_text, with_meta, with_paragraphs
from linkloom.operators.policy import DenyPolicy
from linkloom.operators.state import last_chunks, pending_members, pending_urls
from linkloom.operators.stats import count_archives, data_archives, pending_archives
from linkloom.sources.archives import read_members
from linkloom.sources.files import list_files
from linkloom.operators.tokens import COMBINE, FILES_PER_BATCH, MIN_LENGTH, pack_tokens
from linkloom.session import has_at_most

# Keys of done URLs that are broadcast at most.
STATE_ROWS = 5_000_000


def undated(df: DataFrame, file: str = "src_file") -> DataFrame:
    """Files whose name tells no year and month; they have no place in the order of sightings."""
    found = year_month(F.col(file))
    bad = found["year"].isNull() | found["month"].isNull()
    return df.filter(bad).select(F.col(file).alias("file"), F.lit("no_month").alias("reason")).distinct()


def link_corpus(
    lines: DataFrame, policy: DenyPolicy = DenyPolicy(), min_karma: int = 3, mode: str = "full"
) -> DataFrame:
    """Dump lines to globally first-seen good links; one shuffle, on the URL key.

    Files without a month in their name are left out: ``undated`` lists them.
    """
    found = year_month(F.col("src_file"))
    dated = lines.filter(found["year"].isNotNull() & found["month"].isNotNull())
    hits = parse_submissions(dated, policy, min_karma).filter("status = 'hit'")
    return dedupe_urls(
        hits.select(
            F.col("src_file").alias("file"),
            found["year"].alias("year"),
            found["month"].alias("month"),
            F.col("line_no").alias("uid"),
            "url",
        ),
        mode,
    )


def page_corpus(pages: DataFrame, policy: DenyPolicy = DenyPolicy()) -> DataFrame:
    """Vetted, deduplicated pages with paragraph and word counts.

    Pages are vetted and counted where they are read, and only the counts go through the
    shuffle that dedups URLs: ``html`` never leaves its task.
    """
    vetted = good_links(pages.select("page_id", "url", "html"), policy)
    counted = with_paragraphs(vetted, name="_p").select(
        "page_id",
        "url",
        F.size("_p").cast("bigint").alias("n_paragraphs"),
        H.paragraph_words(F.col("_p")).alias("n_words"),
    )
    parsable, _ = split_unparsable(counted)
    return keep_first(with_url_key(parsable), ("page_id",)).drop("url_key")


def scrape_corpus(
    landed: DataFrame,
    state: DataFrame,
    mode: str = "visible",
    size: int = 100,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Landed pages ``(month, uid, url, html)`` to documents with id, metadata and chunk.

    Chunks are cut over all pending URLs, as documents without content still count, and go on after the
    last chunk of each month in ``state``, so that a second run adds to the first one's folders.  Text is
    extracted where the pages are read, and what is numbered is the text: no ``html`` is moved.  Pages
    that are done are dropped before extraction where their keys fit a broadcast, else right behind it.
    A page without a month or id is in no state, so it is pending, and is numbered with the others.
    """
    if has_at_most(state, STATE_ROWS):
        pending = pending_urls(landed, F.broadcast(state))
        texts = extract_all(pending, mode)
    else:
        texts = pending_urls(extract_all(landed, mode), state)
    texts = with_meta(texts, mode).select("month", "uid", "url", "text", "meta")
    # The hash is of the URL alone: a column of the text would have pages extracted for the counts too.
    spread = F.xxhash64("url")
    docs = nonempty_text(assign_chunks(texts, size, last_chunks(state), rows=rows, spread=spread))
    return docs.select(
        "month", "uid", doc_fid(F.col("uid"), F.col("url")).alias("fid"), "text", "meta", "chunk_id"
    )


def extract_corpus(pages: DataFrame, done: DataFrame) -> DataFrame:
    """Text of archive members ``(month, fid, html)`` that have none yet; empty texts dropped."""
    return nonempty_text(main_text(pending_members(pages, done)), strip=False)


def count_new(spark, path, cache: DataFrame, glob: str | None = None) -> DataFrame:
    """Counts of the data archives that the cache does not hold; the others are not opened."""
    listed = data_archives(list_files(spark, path, glob).withColumnRenamed("path", "archive"))
    return count_archives(read_members(pending_archives(listed, cache), content=False))


def token_corpus(
    encoded: DataFrame,
    combine: int = COMBINE,
    min_length: int = MIN_LENGTH,
    batch_size: int = FILES_PER_BATCH,
) -> DataFrame:
    """Shards of an encoded table: documents and tokens in each."""
    packed = pack_tokens(encoded, combine, min_length, batch_size)
    return packed.groupBy("batch_id", "shard_id").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
