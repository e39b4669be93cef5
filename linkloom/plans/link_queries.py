"""Registered queries of the link stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import strings as S
from linkloom.functions import urls as U
from linkloom.functions.arrow import html_unescape
from linkloom.operators import dedup, hosts, links, numbering, seen
from linkloom.operators.policy import DenyPolicy, policy_table
from linkloom.session import shared_folder

# The test hosts are on no default list, so the queries bring a policy of their own.
POLICY = DenyPolicy(
    domains=("example.net", "spam-farm.example.org"),
    hosts=("www.cheap-pills.example.com", "example.com"),
    suffixes=(".html", "/"),
    min_length=42,
)

HOST_SQL = (
    "split_part(split_part(split_part("
    r"regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/', 1), '?', 1), '#', 1)"
)
DENIED_SQL = (
    "(h = 'example.net' OR h LIKE '%.example.net' OR h = 'spam-farm.example.org'"
    " OR h LIKE '%.spam-farm.example.org' OR h IN ('www.cheap-pills.example.com', 'example.com'))"
)
EXTENSION_SQL = (
    "(lower(split_part(url, '?', 1)) LIKE '%.html' OR lower(split_part(url, '?', 1)) LIKE '%/')"
)
REASON_SQL = (
    f"CASE WHEN {DENIED_SQL} THEN 'domain' WHEN {EXTENSION_SQL} THEN 'extension'"
    " WHEN length(url) < 42 THEN 'length' END"
)
HOSTED_SQL = f"SELECT page_id, url, {HOST_SQL} AS h FROM pages"
# The suffix is cut off host ``h`` by case; what is left ends with the domain.
HOST_PARTS_SQL = f"""
  SELECT page_id, CASE WHEN l LIKE '%.%' THEN regexp_replace(l, '[.][^.]*$', '') ELSE '' END AS subdomain,
    string_split(l, '.')[-1] AS domain, s AS suffix,
    CASE WHEN l <> '' AND s <> '' THEN concat(string_split(l, '.')[-1], '.', s) ELSE '' END AS registered_domain
  FROM (SELECT page_id, s, CASE WHEN s = '' THEN h WHEN h = s THEN '' ELSE left(h, length(h) - length(s) - 1) END AS l
    FROM (SELECT page_id, h, CASE
      WHEN h = 'cheap-pills.example.com' OR h LIKE '%.cheap-pills.example.com' THEN 'example.com'
      WHEN h LIKE '%.example.com' THEN concat(string_split(h, '.')[-3], '.example.com')
      WHEN h = 'example.net' OR h LIKE '%.example.net' THEN 'example.net'
      WHEN string_split(h, '.')[-1] IN ('com', 'net', 'org') THEN string_split(h, '.')[-1]
      ELSE '' END AS s FROM ({HOSTED_SQL})))"""
# Every tail of every host against every form of a rule.
HOST_PARTS_LARGE_SQL = f"""
  WITH r AS (SELECT unnest(['com', 'net', 'org', 'example.net', '*.example.com', '!cheap-pills.example.com']) AS rule
      UNION SELECT h FROM ({HOSTED_SQL}) WHERE page_id % 3 = 1),
    t AS (SELECT h, string_split(h, '.') AS w, unnest(range(1, len(string_split(h, '.')) + 1)) AS k
      FROM (SELECT DISTINCT h FROM ({HOSTED_SQL}))),
    m AS (SELECT h, max(CASE WHEN r.rule LIKE '!%' THEN k - 1 END) AS x,
        max(CASE WHEN r.rule NOT LIKE '!%' THEN k END) AS y
      FROM t JOIN r ON r.rule = array_to_string(w[-k:], '.') OR r.rule = '!' || array_to_string(w[-k:], '.')
        OR (k > 1 AND r.rule = '*.' || array_to_string(w[len(w) - k + 2:], '.'))
      GROUP BY h),
    p AS (SELECT page_id, string_split(h, '.') AS w, coalesce(x, y, 0) AS n
      FROM ({HOSTED_SQL}) LEFT JOIN m USING (h)),
    q AS (SELECT page_id, w[:len(w) - n] AS a, array_to_string(w[len(w) - n + 1:], '.') AS suffix FROM p)
  SELECT page_id, array_to_string(a[:len(a) - 1], '.') AS subdomain, coalesce(a[-1], '') AS domain, suffix,
    CASE WHEN len(a) > 0 AND suffix <> '' THEN concat(a[-1], '.', suffix) ELSE '' END AS registered_domain
  FROM q"""


def table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def urls(spark, d) -> DataFrame:
    return table(spark, d, "pages").select("page_id", "url")


# --- vetting -------------------------------------------------------------------------------


def vet_links(spark, d):
    return links.vet_links(urls(spark, d), POLICY)


def deny_domains(spark, d):
    return links.deny_domains(urls(spark, d), policy_table(spark, POLICY))


def deny_large_policy(spark, d):
    """A policy with the hosts of a third of the pages, taken the way that broadcasts nothing."""
    listed = urls(spark, d).filter("page_id % 3 = 1").select(
        U.url_host(F.col("url")).alias("pattern"), F.lit("host").alias("match_kind")
    )
    policy = policy_table(spark, POLICY).union(listed)
    return links.deny_domains(urls(spark, d), policy, broadcast_rows=0)


# Suffix rules over the test hosts: a plain one below another, a wildcard and an exception to it.
SUFFIX_RULES = ("com", "net", "org", "example.net", "*.example.com", "!cheap-pills.example.com")


def _host_parts(spark, d, rules, **options):
    parted = hosts.with_host_parts(urls(spark, d), rules, name="p", **options)
    return parted.select("page_id", "p.subdomain", "p.domain", "p.suffix", "p.registered_domain")


def host_parts(spark, d):
    return _host_parts(spark, d, spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string"))


def host_parts_large_list(spark, d):
    """A rule for the host of every third page as well, taken the way that broadcasts nothing."""
    listed = urls(spark, d).filter("page_id % 3 = 1").select(U.url_host(F.col("url")).alias("rule"))
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string").union(listed)
    return _host_parts(spark, d, rules, broadcast_rows=0)


def deny_extensions(spark, d):
    return links.deny_extensions(urls(spark, d), POLICY)


def min_url_length(spark, d):
    return links.min_url_length(urls(spark, d), POLICY.min_length)


def reject_reasons(spark, d):
    return links.reject_reasons(vet_links(spark, d))


# --- submissions ---------------------------------------------------------------------------


def submissions(spark, d) -> DataFrame:
    """JSON lines made from the pages, with the flaws real dumps have."""
    n = F.col("page_id")
    score = (n % 7).cast("double") / 2 + 1
    record = F.to_json(
        F.struct("url", score.alias("score"), (n % 11 == 0).alias("over_18"), "page_id")
    )
    value = (
        F.when(n % 10 == 3, F.expr("substr(r, 1, length(r) - 5)"))
        .when(n % 20 == 6, F.concat("r", F.lit(" trailing")))
        .when(n % 20 == 16, F.concat("r", F.lit(",{}] junk")))
        .when(n % 30 == 7, F.regexp_replace("r", '"score":[0-9.]+', '"score":"high"'))
        .when(n % 30 == 17, F.regexp_replace("r", '"url":"[^"]*",', ""))
        .when(n % 30 == 27, F.regexp_replace("r", '"over_18":(true|false)', '"over_18":null'))
        .otherwise(F.col("r"))
    )
    month = F.format_string("RS_2016-%02d.xz", n % 4 + 1)
    return table(spark, d, "pages").select("page_id", "url", record.alias("r")).select(
        month.alias("src_file"), n.alias("line_no"), value.alias("value")
    )


def parsed_submissions(spark, d):
    return links.parse_submissions(submissions(spark, d), POLICY)


def parse_submissions(spark, d):
    return parsed_submissions(spark, d).select("src_file", "line_no", "status")


def submission_stats(spark, d):
    return links.submission_stats(parsed_submissions(spark, d))


def good_submissions(spark, d):
    """Karma and age tests on typed columns, apart from the parser."""
    n = F.col("page_id")
    typed = urls(spark, d).select(
        "page_id",
        "url",
        ((n % 7).cast("double") / 2 + 1).alias("score"),
        F.when(n % 5 != 0, n % 11 == 0).alias("over_18"),
    )
    return links.drop_over18(links.min_karma(typed, 3)).select("page_id", "url")


STATUS_SQL = f"""
SELECT printf('RS_2016-%02d.xz', page_id % 4 + 1) AS src_file, page_id AS line_no,
  CASE WHEN page_id % 10 IN (3, 6) THEN 'undecodable'
       WHEN page_id % 30 = 17 THEN 'bad_url'
       WHEN {REASON_SQL} IS NOT NULL THEN {REASON_SQL}
       WHEN page_id % 30 = 7 THEN 'bad_score'
       WHEN NOT ((page_id % 7) / 2.0 + 1 > 2) THEN 'karma'
       WHEN page_id % 30 <> 27 AND page_id % 11 = 0 THEN 'adult'
       ELSE 'hit' END AS status
FROM ({HOSTED_SQL})
"""


# --- URL functions -------------------------------------------------------------------------


def url_parts(spark, d):
    p = F.col("parts")
    return U.with_url_parts(urls(spark, d)).select(
        "page_id",
        *[p[c].alias(c) for c in ("scheme", "netloc", "path", "params", "query", "fragment")],
        U.url_host(F.col("url")).alias("host"),
        F.array_join(U.host_suffixes(U.url_host(F.col("url"))), " ").alias("suffixes"),
        U.decode_path(p["path"]).alias("decoded_path"),
        F.array_join(
            F.transform(U.canonical_query(p["query"]), lambda x: F.concat_ws("=", x["k"], x["v"])), "&"
        ).alias("canonical_query"),
    )


URL_PARTS_SQL = r"""
SELECT page_id, scheme, netloc, path, '' AS params, query, fragment, netloc AS host,
  array_to_string([array_to_string(l[i:], '.') for i in range(1, len(l) + 1)], ' ') AS suffixes,
  url_decode(replace(path, '+', ' ')) AS decoded_path,
  array_to_string(list_sort(list_distinct(
    [url_decode(replace(q, '+', ' ')) for q in string_split(query, '&')
     if regexp_matches(q, '=.')])), '&') AS canonical_query
FROM (SELECT page_id,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
  regexp_extract(url, '^[^:]*://([^/?#]*)', 1) AS netloc,
  regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query,
  regexp_extract(url, '#(.*)$', 1) AS fragment,
  string_split(regexp_extract(url, '^[^:]*://([^/?#]*)', 1), '.') AS l
FROM pages)
"""


def doc_fid(spark, d):
    padded = F.concat(F.lit(" "), F.col("url"), F.lit("\n"))
    return urls(spark, d).select("page_id", S.doc_fid(F.col("page_id"), padded).alias("fid"))


def content_md5(spark, d):
    return table(spark, d, "pages").select("page_id", S.content_md5(F.col("html")).alias("md5"))


def names(spark, d) -> DataFrame:
    """File names with a month for each event, in the forms the stages use."""
    n = F.col("event_id")
    day = F.format_string("%d-%02d", F.lit(2024) - F.col("user_id") % 4, F.col("user_id") % 12 + 1)
    name = (
        F.when(n % 4 == 0, F.concat(F.lit("dumps/RS_v2_"), day, F.lit(".xz.goodlinks.txt")))
        .when(n % 4 == 1, F.concat(F.lit("scraped/RS_"), day, F.lit("-4_data.xz")))
        .when(n % 4 == 2, F.concat(F.lit("url_data/RS_"), day, F.lit("-4_meta.xz")))
        .otherwise(F.concat(F.lit("other/list_"), day, F.lit(".bz2")))
    )
    return table(spark, d, "events").select("event_id", name.alias("path"))


NAMES_SQL = """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN 'dumps/RS_v2_' || day || '.xz.goodlinks.txt'
  WHEN 1 THEN 'scraped/RS_' || day || '-4_data.xz'
  WHEN 2 THEN 'url_data/RS_' || day || '-4_meta.xz'
  ELSE 'other/list_' || day || '.bz2' END AS path
FROM (SELECT event_id,
  printf('%d-%02d', 2024 - user_id % 4, user_id % 12 + 1) AS day FROM events)
"""


def month_label(spark, d):
    # The last two forms have no number behind the last underscore at the right place.
    found = S.year_month(F.col("path"))
    return names(spark, d).select(
        "event_id",
        S.month_label(F.col("path")).alias("label"),
        found["year"].alias("year"),
        found["month"].alias("month"),
        S.deduped_name(F.col("path")).alias("deduped"),
        S.archive_name(S.month_label(F.col("path")), F.col("event_id")).alias("archive"),
        S.tokenized_name(F.col("path")).alias("tokenized"),
    )


MONTH_LABEL_SQL = rf"""
SELECT event_id, regexp_extract(base, '^(RS_.*2\d{{3}}-\d{{2}})', 1) AS label,
  TRY_CAST(string_split(stem, '-')[1] AS INTEGER) AS year,
  TRY_CAST(string_split(stem, '-')[2] AS INTEGER) AS month,
  replace(path, 'goodlinks.txt', 'deduped.txt') AS deduped,
  regexp_extract(base, '^(RS_.*2\d{{3}}-\d{{2}})', 1) || '-' || event_id || '_data.xz' AS archive,
  replace(base, '.txt', '.tokenized.txt') AS tokenized
FROM (SELECT *, string_split(path, '/')[-1] AS base,
  substr(string_split(regexp_replace(path, '\.[^.]*$', ''), '_')[-1], 1, 7) AS stem
  FROM ({NAMES_SQL}))
"""


def select_dumps(spark, d):
    from linkloom.sources.dumps import select_dumps as select

    return select(names(spark, d).select("path"), 2022, 2023)


def data_archives(spark, d):
    from linkloom.operators.stats import data_archives as keep

    return keep(names(spark, d), "path")


# --- dedup ---------------------------------------------------------------------------------

# How each page URL is written again: some forms equal the first, some stay apart, one cannot
# be parsed.  ``u`` is the URL; every form also tells its number.
VARIANTS = (
    "u",
    "replace(u, '&', '&amp;')",
    "concat(upper(substr(u, 1, 4)), substr(u, 5))",
    "replace(u, '/en/', '/%65n/')",
    "concat(u, '#again')",
    "replace(u, '?', '?blank=&page=2&')",
    "replace(u, '/en/', '/en;v=1/x;v=2/')",
    "replace(u, '://', '://[')",
    "concat(u, '&copy;=1')",
)


def url_lists(spark, d) -> DataFrame:
    forms = F.array(*[F.expr(v) for v in VARIANTS])
    listed = urls(spark, d).select("page_id", F.col("url").alias("u")).select(
        "page_id", F.posexplode(forms).alias("v", "url")
    )
    n = F.col("page_id")
    month = (n * 5 + F.col("v")) % 3 + 1
    return listed.select(
        F.lit(2016).alias("year"),
        month.cast("int").alias("month"),
        F.format_string("RS_2016-%02d-%d", month, F.col("v") % 2).alias("file"),
        (n * len(VARIANTS) + F.col("v")).alias("uid"),
        "url",
    )


def dedupe_urls(spark, d):
    return dedup.dedupe_urls(url_lists(spark, d)).select("month", "file", "uid", "url")


def dedupe_by_month(spark, d):
    """The lists month by month, each run against the keys that earlier ones have left."""
    name, folder = f"seen_{uuid.uuid4().hex}", f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    seen.create_seen(spark, name, folder, buckets=8)
    lists = url_lists(spark, d)
    for month in (1, 2, 3):
        seen.dedupe_run(lists.where(F.col("month") == month), name, f"2016-{month:02d}")
    return spark.table(name).select("month", "file", "uid", "url")


def dedupe_host_path(spark, d):
    return dedup.dedupe_urls(url_lists(spark, d), "host_path").select("month", "file", "uid", "url")


def first_seen_rank(spark, d):
    parsable, _ = dedup.split_unparsable(url_lists(spark, d))
    return numbering.first_seen_rank(U.with_url_key(parsable), rows=200).select("uid", "seen_rank")


def unparsable_urls(spark, d):
    _, rejects = dedup.split_unparsable(url_lists(spark, d))
    return rejects.select("uid", "url", "reason")


def source_stats(spark, d):
    listed = url_lists(spark, d)
    return dedup.source_stats(listed, dedup.dedupe_urls(listed), "file")


_LISTED = " UNION ALL ".join(
    f"SELECT page_id, {v} AS v, {form} AS raw FROM (SELECT page_id, url AS u FROM pages)"
    for v, form in enumerate(VARIANTS)
)
LISTED_SQL = rf"""
SELECT (page_id * 5 + v) % 3 + 1 AS month,
  printf('RS_2016-%02d-%d', (page_id * 5 + v) % 3 + 1, v % 2) AS file,
  page_id * {len(VARIANTS)} + v AS uid,
  replace(replace(raw, '&copy;', '©'), '&amp;', '&') AS url
FROM ({_LISTED})
"""
KEYED_SQL = rf"""
SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
  regexp_extract(url, '^[^:]*://([^/?#]*)', 1) AS netloc,
  url_decode(replace(regexp_extract(whole_path, '^((?:.*/)?[^;/]*)', 1), '+', ' ')) AS path,
  regexp_extract(whole_path, ';([^/]*)$', 1) AS params,
  list_sort(list_distinct(
    [url_decode(replace(q, '+', ' ')) for q in string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&')
     if regexp_matches(q, '=.')])) AS query,
  regexp_extract(url, '#(.*)$', 1) AS fragment
FROM (SELECT *, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS whole_path
      FROM ({LISTED_SQL}))
"""
RANKED_SQL = f"""
SELECT *, row_number() OVER (
    PARTITION BY scheme, netloc, path, params, query, fragment ORDER BY month, file, uid) AS n,
  row_number() OVER (PARTITION BY netloc, path ORDER BY month, file, uid) AS n_host_path
FROM ({KEYED_SQL}) WHERE netloc NOT LIKE '%[%'
"""


def url_unescape(spark, d):
    return url_lists(spark, d).select("uid", html_unescape(F.col("url")).alias("url"))


QUERIES = {
    "vet_links": (vet_links, f"SELECT page_id, url, {REASON_SQL} AS reject_reason FROM ({HOSTED_SQL})"),
    "deny_domains": (deny_domains, f"SELECT page_id, url FROM ({HOSTED_SQL}) WHERE NOT {DENIED_SQL}"),
    "deny_large_policy": (
        deny_large_policy,
        f"""SELECT page_id, url FROM ({HOSTED_SQL}) WHERE NOT {DENIED_SQL}
              AND h NOT IN (SELECT h FROM ({HOSTED_SQL}) WHERE page_id % 3 = 1)""",
    ),
    "deny_extensions": (
        deny_extensions, f"SELECT page_id, url FROM pages WHERE NOT {EXTENSION_SQL}"
    ),
    "min_url_length": (min_url_length, "SELECT page_id, url FROM pages WHERE length(url) >= 42"),
    "reject_reasons": (
        reject_reasons,
        f"SELECT coalesce(r, 'kept') AS reject_reason, count(*) AS n_links"
        f" FROM (SELECT {REASON_SQL} AS r FROM ({HOSTED_SQL})) GROUP BY 1",
    ),
    "parse_submissions": (parse_submissions, STATUS_SQL),
    "submission_stats": (
        submission_stats,
        f"""SELECT src_file, count(*) AS n_lines, count(*) FILTER (status = 'hit') AS n_hits,
          count(*) FILTER (status IN ('undecodable', 'bad_url', 'bad_score', 'bad_over_18')) AS n_errors,
          CAST(floor(100.0 * count(*) FILTER (status = 'hit') / count(*)) AS INTEGER) AS percent_saved
        FROM ({STATUS_SQL}) GROUP BY src_file""",
    ),
    "good_submissions": (
        good_submissions,
        """SELECT page_id, url FROM pages WHERE (page_id % 7) / 2.0 + 1 > 2
           AND NOT (page_id % 5 <> 0 AND page_id % 11 = 0)""",
    ),
    "url_parts": (url_parts, URL_PARTS_SQL),
    "host_parts": (host_parts, HOST_PARTS_SQL),
    "host_parts_large_list": (host_parts_large_list, HOST_PARTS_LARGE_SQL),
    "doc_fid": (
        doc_fid, "SELECT page_id, printf('%07d-%s', page_id, md5(url)) AS fid FROM pages"
    ),
    "content_md5": (content_md5, "SELECT page_id, md5(html) AS md5 FROM pages"),
    "month_label": (month_label, MONTH_LABEL_SQL),
    "select_dumps": (
        select_dumps,
        f"SELECT DISTINCT path FROM ({NAMES_SQL})"
        " WHERE regexp_matches(string_split(path, '/')[-1], '2022|2023')",
    ),
    "data_archives": (
        data_archives, f"SELECT * FROM ({NAMES_SQL}) WHERE path LIKE '%data%' AND path LIKE '%.xz'"
    ),
    "url_unescape": (url_unescape, f"SELECT uid, url FROM ({LISTED_SQL})"),
    "dedupe_urls": (
        dedupe_urls, f"SELECT month, file, uid, url FROM ({RANKED_SQL}) WHERE n = 1"
    ),
    "dedupe_by_month": (
        dedupe_by_month,
        f"SELECT CAST(month AS INTEGER) AS month, file, uid, url FROM ({RANKED_SQL}) WHERE n = 1",
    ),
    "dedupe_host_path": (
        dedupe_host_path, f"SELECT month, file, uid, url FROM ({RANKED_SQL}) WHERE n_host_path = 1"
    ),
    "first_seen_rank": (first_seen_rank, f"SELECT uid, n AS seen_rank FROM ({RANKED_SQL})"),
    "unparsable_urls": (
        unparsable_urls,
        f"SELECT uid, url, 'unparsable' AS reason FROM ({LISTED_SQL}) WHERE url LIKE '%://[%'",
    ),
    "source_stats": (
        source_stats,
        f"""SELECT file, count(*) AS n_urls, count(*) FILTER (uid IN (
              SELECT uid FROM ({RANKED_SQL}) WHERE n = 1)) AS n_kept
            FROM ({LISTED_SQL}) GROUP BY file""",
    ),
}
