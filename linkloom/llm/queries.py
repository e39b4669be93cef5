"""Registered queries of the operators and the pipeline, with SQL forms where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm.decontam import contamination
from linkloom.llm.exact import exact_groups
from linkloom.llm.mixing import label_domains, mixing_rates
from linkloom.llm.pii import find_pii
from linkloom.llm.quality import score_quality
from linkloom.llm.ranking import search
from linkloom.llm.secrets import find_secrets
from linkloom.llm.sharding import shard_documents
from linkloom.llm.simhash import simhash_groups
from linkloom.llm.substring import repeated_passages
from linkloom.llm.suffixes import repeated_bytes
from linkloom.llm.urlfilter import judge_urls, url_host
from linkloom.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op2_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body,
             regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]', '', 'g') AS norm
      FROM documents)
WINDOW best AS (PARTITION BY norm ORDER BY length(body) DESC, doc_id)
"""


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


#: Shares of all tokens that the mix asks for.
MIX_TARGETS = {"clean": 0.9, "low": 0.07, "toxic": 0.03}


def op4_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = label_domains(table(spark, sf_dir, "labels"))
    return mixing_rates(table(spark, sf_dir, "documents"), labelled, MIX_TARGETS)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 40)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH words AS (
  SELECT r, doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT row_number() OVER () AS r, * FROM documents)),
items AS (
  SELECT item_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT *, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
windows AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT r, i, windows.n, item_id FROM windows JOIN grams USING (gram)),
covered AS (SELECT r, count(DISTINCT i + k) AS n_hit
            FROM (SELECT r, i, unnest(range(0, n)) AS k FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: about an eighth of the crawl's URLs, by a hash, each written in another way."""
    pages = table(spark, sf_dir, "pages")
    chosen = pages.where(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 1).isin("3", "b"))
    plain = F.split(F.col("url"), "#", 2)[0]
    tracked = F.when(plain.contains("?"), F.concat(plain, F.lit("&utm_source=list"))).otherwise(
        F.concat(plain, F.lit("?ref=list"))
    )
    return judge_urls(pages, chosen.select(tracked.alias("url")), URL_RULES)


OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                            ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, contains(coalesce(url, ''), '://') AS good,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut),
canon AS (
  SELECT page_id, host, path,
         CASE WHEN good THEN regexp_replace(host, '^www\.', '')
           || regexp_replace(path, '(\.html|/)$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END
         END AS canonical
  FROM (SELECT *, array_to_string(list_filter(string_split(query, '&'), lambda p: p <> ''
            AND split_part(p, '=', 1) <> 'ref' AND NOT starts_with(p, 'utm_')), '&') AS q FROM parts)),
listed AS (SELECT DISTINCT canon.canonical FROM canon JOIN pages USING (page_id)
           WHERE substr(md5(coalesce(url, '')), 1, 1) IN ('3', 'b') AND canon.canonical IS NOT NULL),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1')
      THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/')
      THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM canon)
SELECT page_id, host, path, rule, ruled.canonical,
       listed.canonical IS NOT NULL AS listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed ON ruled.canonical = listed.canonical
"""


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 200) AS s
      FROM (SELECT *, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
later AS (SELECT r, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
marked AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 100, true) AS new FROM later),
runs AS (SELECT r, min(i) AS lo, max(i) + 100 AS hi
         FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g),
gaps AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS past FROM runs),
cut AS (SELECT r, count(*) AS n_spans, CAST(sum(hi - lo) AS BIGINT) AS n_removed,
               string_agg(substr(h, 2 * past + 1, 2 * (lo - past)), '' ORDER BY lo)
                 || substr(any_value(h), 2 * max(hi) + 1) AS kept
        FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
q AS (
  SELECT row_number() OVER () AS i, item_id, unnest(list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM tf, total GROUP BY term, docs),
worth AS (
  SELECT r, term, weight * ((1000000000 * tf)
           // (1000 * tf + 12 * (75 + (25 * len(w) * docs) // terms))) AS worth
  FROM tf JOIN weights USING (term) JOIN d USING (r), total),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(worth) AS BIGINT) AS score
           FROM q JOIN worth USING (term) JOIN d USING (r) GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS n
           FROM scored WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 20
"""

QUERIES = {
    "op1_secrets": (op1_secrets, None),
    "op2_exact_groups": (op2_exact_groups, OP2_SQL),
    "op3_simhash_groups": (op3_simhash_groups, None),
    "op4_mixing_rates": (op4_mixing_rates, None),
    "op5_pii": (op5_pii, None),
    "op6_quality": (op6_quality, None),
    "op7_shards": (op7_shards, None),
    "op8_decontaminate": (op8_decontaminate, OP8_SQL),
    "op9_url_verdicts": (op9_url_verdicts, OP9_SQL),
    "op10_repeated_passages": (op10_repeated_passages, None),
    "op11_repeated_bytes": (op11_repeated_bytes, OP11_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_ranked_search": (op13_ranked_search, OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
