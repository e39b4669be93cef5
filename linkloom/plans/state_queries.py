"""Registered queries of numbering, chunks, incremental state and counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from linkloom.functions.strings import doc_fid
from linkloom.operators import numbering, state, stats
from linkloom.plans import corpus
from linkloom.plans.link_queries import table
from linkloom.plans.page_queries import VISIBLE_SQL, WORDS_SQL
from linkloom.session import shared_folder
from linkloom.sinks import reports
from linkloom.sinks.members import bucketed_pending, extract_bucketed, write_bucketed

MONTH_SQL = "printf('RS_2016-%02d', page_id % 3 + 1)"
# Chunks of 20 and number ranges of 50 ids: small, so that many buckets take part.
SIZE, ROWS = 20, 50


def month():
    return F.format_string("RS_2016-%02d", F.col("page_id") % 3 + 1).alias("month")


def url_table(spark, d):
    """URL lists as a table: month, line number and URL; every third id is done."""
    return table(spark, d, "pages").select(month(), F.col("page_id").alias("uid"), "url")


def done_urls(spark, d):
    done = url_table(spark, d).filter("uid % 5 = 0")
    return done.select("month", "uid", F.floor(F.col("uid") / 100).alias("chunk_id"))


def landed(spark, d):
    return table(spark, d, "pages").select(
        month(), F.col("page_id").alias("uid"), "url", "html"
    )


def members(spark, d):
    """Archive members by document id; those with an id divisible by 4 have a text already."""
    fid = doc_fid(F.col("uid"), F.col("url"))
    html = F.when(F.col("uid") % 9 == 1, "<script>x</script>").otherwise(F.col("html"))
    return landed(spark, d).select("month", fid.alias("fid"), "uid", html.alias("html"))


def done_members(spark, d):
    return members(spark, d).filter("uid % 4 = 0").select("month", "fid")


def number_lines(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return numbering.number_lines(docs, "source", "doc_id", rows=100)


def pending_urls(spark, d):
    return state.pending_urls(url_table(spark, d), done_urls(spark, d))


def limit_pending(spark, d):
    return numbering.limit_pending(pending_urls(spark, d).select("uid", "url"), 25)


def gappy(spark, d):
    """Line numbers of which every ninth is not known."""
    docs = table(spark, d, "documents")
    known = F.when(F.col("doc_id") % 9 != 4, F.col("doc_id"))
    return docs.select("doc_id", "source", known.alias("line"))


def unknown_lines(spark, d):
    """Rows without a line number come first in their source; among them any order will do."""
    ranks = numbering.number_lines(gappy(spark, d), "source", "line", rows=100)
    return ranks.select("source", "line", "uid")


def limit_unknown(spark, d):
    """Half the table, ids far apart: the limit counts rows without a number, and first."""
    apart = gappy(spark, d).select("source", (F.col("line") * 10**12).alias("uid"))
    return numbering.limit_pending(apart, 10**6).groupBy("uid").count().withColumnRenamed("count", "n")


def pending_years(spark, d):
    """The same month of two years: what is done in one stays pending in the other."""
    urls = url_table(spark, d).withColumn("uid", F.floor(F.col("uid") / 2))
    label = F.concat(F.lit("RS_201"), (F.col("uid") % 2 + 6).cast("string"), F.substring("month", 8, 3))
    years = urls.withColumn("month", label)
    return state.pending_urls(years, years.filter("month = 'RS_2016-02'"))


def chunk_urls(spark, d):
    prev = state.last_chunks(done_urls(spark, d).filter("month != 'RS_2016-02'"))
    return numbering.assign_chunks(pending_urls(spark, d), SIZE, prev, rows=ROWS).select(
        "month", "uid", "chunk_id"
    )


def chunk_report(spark, d):
    status = (
        F.when(F.col("uid") % 13 == 1, "timeout").when(F.col("uid") % 11 == 1, "empty").otherwise("ok")
    )
    return stats.chunk_report(chunk_urls(spark, d).withColumn("status", status))


def append_state(spark, d):
    return state.append_state(done_urls(spark, d), url_table(spark, d).filter("uid % 7 = 0"))


def last_chunks(spark, d):
    return state.last_chunks(done_urls(spark, d))


def pending_members(spark, d):
    return state.pending_members(members(spark, d), done_members(spark, d)).select("month", "fid")


def extract_report(spark, d):
    from linkloom.operators.pages import main_text

    pages, done = members(spark, d), done_members(spark, d)
    return stats.extract_report(pages, done, main_text(state.pending_members(pages, done)))


def extract_texts(spark, d):
    """The same report, counted by the job that writes the texts."""
    months = [f"RS_2016-{n:02d}" for n in (1, 2, 3)]
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    report = reports.extract_texts(members(spark, d), done_members(spark, d), folder, months)
    counts = "month string, n_total bigint, n_done bigint, n_unparsable bigint, n_written bigint"
    written = spark.read.parquet(folder).groupBy("month").agg(F.count("*").alias("n"))
    n = {r.month: r.n for r in written.collect()}
    rows = [(*r.values(), n.get(r["month"], sum(n.values()))) for r in report]
    return spark.createDataFrame(rows, counts)


def extract_corpus(spark, d):
    return corpus.extract_corpus(members(spark, d), done_members(spark, d)).drop("uid")


def scrape_corpus(spark, d):
    docs = corpus.scrape_corpus(landed(spark, d), done_urls(spark, d), size=SIZE, rows=ROWS)
    return docs.select("month", "uid", "fid", "chunk_id", F.col("meta.word_count").alias("word_count"))


def scrape_unlisted(spark, d):
    """Pages of which some have no month and some no line number: all are documents."""
    known = landed(spark, d).withColumns({
        "month": F.when(F.col("uid") % 10 != 3, F.col("month")), "uid": F.when(F.col("uid") % 7 != 2, F.col("uid")),
    })
    docs = corpus.scrape_corpus(known, done_urls(spark, d), size=SIZE, rows=ROWS)
    return docs.select("month", "uid", F.col("meta.url").alias("url"))


def _bucketed(spark, d) -> tuple[str, str, str]:
    """Members and texts as bucketed tables of this call, and where they are."""
    folder, name = f"{shared_folder(spark)}/{uuid.uuid4().hex}", f"members_{uuid.uuid4().hex}"
    texts = done_members(spark, d).select("*", F.lit(None).cast("string").alias("text"), F.lit(None).cast("bigint").alias("word_count"))
    write_bucketed(members(spark, d), name, f"{folder}/members", buckets=8)
    write_bucketed(texts, f"{name}_texts", f"{folder}/texts", buckets=8)
    return name, f"{name}_texts", folder


def bucketed_members(spark, d):
    """The anti-join of members and texts that moves neither."""
    members_table, texts, _ = _bucketed(spark, d)
    return bucketed_pending(spark, members_table, texts).select("month", "fid")


def extract_buckets(spark, d):
    """A run that extracts what is pending into the table of texts, and one that finds nothing to do."""
    members_table, texts, folder = _bucketed(spark, d)
    extract_bucketed(spark, members_table, texts, f"{folder}/texts", 8)
    if extract_bucketed(spark, members_table, texts, f"{folder}/texts", 8):
        raise AssertionError("a second run extracted members again")
    return spark.table(texts).where("text is not null").select("month", "fid", "text", "word_count")


def number_evenly(spark, d):
    """Numbers by ranges drawn from a sample: few different order values, some missing."""
    docs = table(spark, d, "documents").select("source", (F.col("doc_id") / 64).cast("long").alias("line"))
    docs = docs.withColumn("line", F.when(F.col("line") % 5 != 2, F.col("line")))
    ranks = numbering.ranked_evenly(docs, ["source"], ["line"], "uid")
    # Rows of one value come in any order, so their numbers are told as a range.
    return ranks.groupBy("source", "line").agg(
        F.min("uid").alias("first"), F.max("uid").alias("last"), F.countDistinct("uid").alias("n")
    )


def archives(spark, d):
    docs = table(spark, d, "documents")
    name = F.concat(F.lit("scraped/"), "source", F.lit("_data.xz"))
    return docs.select(F.when(F.col("doc_id") % 50 != 7, name).alias("archive"))


def archive_counts(spark, d):
    return stats.archive_counts(archives(spark, d))


def update_counts(spark, d):
    """Cached counts stay as they are, right or wrong, and one archive is no longer there."""
    known = archives(spark, d).filter(F.col("archive").rlike("src1[0-9]"))
    cache = known.distinct().select("archive", F.lit(7).cast("bigint").alias("n_docs"))
    gone = spark.range(1).select(F.lit("scraped/gone_data.xz").alias("archive"), F.lit(3).cast("bigint").alias("n_docs"))
    return stats.update_counts(archives(spark, d), cache.union(gone))


def order_sources(spark, d):
    return numbering.order_sources(archives(spark, d).distinct(), "archive")


URLS_SQL = f"SELECT {MONTH_SQL} AS month, page_id AS uid, url FROM pages"
PENDING_SQL = f"SELECT * FROM ({URLS_SQL}) WHERE uid % 5 <> 0"
CHUNKS_SQL = f"""
SELECT month, uid, CAST((r // {SIZE}) + 1 + CASE WHEN month = 'RS_2016-02' THEN 0 ELSE prev END AS BIGINT) AS chunk_id
FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY uid) - 1 AS r FROM ({PENDING_SQL}))
JOIN (SELECT month, max(uid // 100) AS prev FROM ({URLS_SQL}) WHERE uid % 5 = 0 GROUP BY month)
USING (month)
"""
MEMBERS_SQL = f"""
SELECT {MONTH_SQL} AS month, page_id AS uid, printf('%07d-%s', page_id, md5(url)) AS fid,
  page_id % 4 = 0 AS done, CASE WHEN page_id % 9 = 1 THEN '' ELSE text END AS text
FROM ({VISIBLE_SQL})
"""
ARCHIVES_SQL = """
SELECT CASE WHEN doc_id % 50 <> 7 THEN 'scraped/' || source || '_data.xz' END AS archive FROM documents
"""

QUERIES = {
    "number_lines": (
        number_lines,
        """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS uid
           FROM documents""",
    ),
    "unknown_lines": (
        unknown_lines,
        """SELECT source, line, row_number() OVER (PARTITION BY source ORDER BY line NULLS FIRST) - 1 AS uid
           FROM (SELECT source, CASE WHEN doc_id % 9 <> 4 THEN doc_id END AS line FROM documents)""",
    ),
    "limit_unknown": (
        limit_unknown,
        """SELECT uid, count(*) AS n
           FROM (SELECT CASE WHEN doc_id % 9 <> 4 THEN doc_id * 1000000000000 END AS uid FROM documents
                 ORDER BY uid NULLS FIRST LIMIT 1000000) GROUP BY uid""",
    ),
    "pending_years": (
        pending_years,
        f"""SELECT * FROM (
              SELECT 'RS_201' || CAST(page_id // 2 % 2 + 6 AS VARCHAR) || substr({MONTH_SQL}, 8, 3) AS month,
                page_id // 2 AS uid, url FROM pages) WHERE month <> 'RS_2016-02'""",
    ),
    "pending_urls": (pending_urls, PENDING_SQL),
    "limit_pending": (
        limit_pending, f"SELECT uid, url FROM ({PENDING_SQL}) ORDER BY uid LIMIT 25"
    ),
    "chunk_urls": (chunk_urls, CHUNKS_SQL),
    "chunk_report": (
        chunk_report,
        f"""SELECT month, chunk_id, count(*) AS n_attempted,
              count(*) FILTER (uid % 13 = 1) AS n_timed_out,
              count(*) FILTER (uid % 13 <> 1 AND uid % 11 <> 1) AS n_content
            FROM ({CHUNKS_SQL}) GROUP BY month, chunk_id""",
    ),
    "append_state": (
        append_state, f"SELECT month, uid FROM ({URLS_SQL}) WHERE uid % 5 = 0 OR uid % 7 = 0"
    ),
    "last_chunks": (
        last_chunks,
        f"SELECT month, CAST(max(uid // 100) AS BIGINT) AS prev FROM ({URLS_SQL})"
        " WHERE uid % 5 = 0 GROUP BY month",
    ),
    "pending_members": (pending_members, f"SELECT month, fid FROM ({MEMBERS_SQL}) WHERE NOT done"),
    "extract_report": (
        extract_report,
        f"""SELECT month, count(*) AS n_total, count(*) FILTER (done) AS n_done,
              count(*) FILTER (NOT done AND text = '') AS n_unparsable
            FROM ({MEMBERS_SQL}) GROUP BY month""",
    ),
    "extract_texts": (
        extract_texts,
        f"""SELECT month, count(*) AS n_total, count(*) FILTER (done) AS n_done,
              count(*) FILTER (NOT done AND text = '') AS n_unparsable,
              count(*) FILTER (NOT done AND text <> '') AS n_written
            FROM ({MEMBERS_SQL}) GROUP BY ROLLUP (month)""",
    ),
    "extract_corpus": (
        extract_corpus,
        f"""SELECT month, fid, text, {WORDS_SQL} AS word_count FROM ({MEMBERS_SQL})
            WHERE NOT done AND text <> ''""",
    ),
    "scrape_corpus": (
        scrape_corpus,
        f"""SELECT month, uid, printf('%07d-%s', uid, md5(v.url)) AS fid,
              CAST((r // {SIZE}) + 1 + coalesce(prev, 0) AS BIGINT) AS chunk_id, CAST({WORDS_SQL} AS INTEGER) AS word_count
            FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY uid) - 1 AS r
                  FROM ({PENDING_SQL})) JOIN ({VISIBLE_SQL}) v ON page_id = uid
            LEFT JOIN (SELECT month, max(uid // 100) AS prev FROM ({URLS_SQL})
                       WHERE uid % 5 = 0 GROUP BY month) USING (month)
            WHERE text <> ''""",
    ),
    "scrape_unlisted": (
        scrape_unlisted,
        f"""SELECT CASE WHEN page_id % 10 <> 3 THEN {MONTH_SQL} END AS month,
              CASE WHEN page_id % 7 <> 2 THEN page_id END AS uid, url
            FROM ({VISIBLE_SQL})
            WHERE text <> '' AND (page_id % 10 = 3 OR page_id % 7 = 2 OR page_id % 5 <> 0)""",
    ),
    "bucketed_members": (bucketed_members, f"SELECT month, fid FROM ({MEMBERS_SQL}) WHERE NOT done"),
    "extract_buckets": (
        extract_buckets,
        f"""SELECT month, fid, text, {WORDS_SQL} AS word_count FROM ({MEMBERS_SQL})
            WHERE NOT done AND text <> ''""",
    ),
    "number_evenly": (
        number_evenly,
        """SELECT source, line, min(uid) AS first, max(uid) AS last, count(DISTINCT uid) AS n
           FROM (SELECT source, line, row_number() OVER (PARTITION BY source ORDER BY line NULLS FIRST) - 1 AS uid
                 FROM (SELECT source, CASE WHEN doc_id // 64 % 5 <> 2 THEN doc_id // 64 END AS line FROM documents))
           GROUP BY source, line""",
    ),
    "archive_counts": (
        archive_counts,
        f"""SELECT archive, count(*) AS n_docs, grouping(archive) = 1 AS is_total
            FROM ({ARCHIVES_SQL}) GROUP BY ROLLUP (archive)""",
    ),
    "update_counts": (
        update_counts,
        f"""SELECT archive, CASE WHEN regexp_matches(archive, 'src1[0-9]') THEN 7 ELSE count(*) END AS n_docs
            FROM ({ARCHIVES_SQL}) GROUP BY archive UNION ALL SELECT 'scraped/gone_data.xz', 3""",
    ),
    "order_sources": (order_sources, f"SELECT DISTINCT archive FROM ({ARCHIVES_SQL}) ORDER BY archive"),
}
