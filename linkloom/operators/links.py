"""Link stage: parse submission records, vet links, count what happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.strings import percent
from linkloom.functions.urls import host_suffixes, url_host
from linkloom.operators.policy import DenyPolicy
from linkloom.session import computed_once, has_at_most

BROADCAST_ROWS = 100_000
_RECORD = "array<struct<url variant, score variant, over_18 variant, _end string>>"
# Marks the element that is set behind a line's object, so that no line can stand in for it.
_END = "end of line 5f2b8c"


def _or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# --- vetting -------------------------------------------------------------------------------


def is_denied_domain(url: Column, policy: DenyPolicy = DenyPolicy()) -> Column:
    """Hash-set lookups on the host's last labels; one per label count in the policy."""
    host = url_host(url)
    tests = [host.isin(*policy.hosts)] if policy.hosts else []
    by_labels: dict[int, list[str]] = {}
    for domain in policy.domains:
        by_labels.setdefault(domain.count(".") + 1, []).append(domain)
    for labels, domains in sorted(by_labels.items()):
        tests.append(F.substring_index(host, ".", -labels).isin(*domains))
    return _or_false(_any(tests))


def is_denied_extension(url: Column, policy: DenyPolicy = DenyPolicy()) -> Column:
    """Whatever precedes the first ``?`` ends, in lower case, with a denied suffix."""
    front = F.lower(F.substring_index(url, "?", 1))
    tests = []
    by_dots: dict[int, list[str]] = {}
    for suffix in policy.suffixes:
        if suffix.startswith("."):
            by_dots.setdefault(suffix.count("."), []).append(suffix)
        else:
            tests.append(front.endswith(suffix))
    for dots, suffixes in sorted(by_dots.items()):
        tail = F.concat(F.lit("."), F.substring_index(front, ".", -dots))
        whole = F.length(tail) > F.length(front)
        tests.append(tail.isin(*suffixes) & ~whole)
    return _or_false(_any(tests))


def is_short_url(url: Column, policy: DenyPolicy = DenyPolicy()) -> Column:
    return _or_false(F.length(url) < policy.min_length)


def _any(tests: list[Column]) -> Column:
    found = F.lit(False)
    for test in tests:
        found = found | test
    return found


def reject_reason(url: Column, policy: DenyPolicy = DenyPolicy()) -> Column:
    """First reason against a link, in the order domain, extension, length; null if good."""
    return (
        F.when(url.isNull(), "missing")
        .when(is_denied_domain(url, policy), "domain")
        .when(is_denied_extension(url, policy), "extension")
        .when(is_short_url(url, policy), "length")
    )


def vet_links(df: DataFrame, policy: DenyPolicy = DenyPolicy(), url: str = "url") -> DataFrame:
    """Add ``reject_reason``; good links have none."""
    return df.withColumn("reject_reason", reject_reason(F.col(url), policy))


def good_links(df: DataFrame, policy: DenyPolicy = DenyPolicy(), url: str = "url") -> DataFrame:
    return df.filter(reject_reason(F.col(url), policy).isNull())


def deny_extensions(df: DataFrame, policy: DenyPolicy = DenyPolicy(), url: str = "url") -> DataFrame:
    return df.filter(~is_denied_extension(F.col(url), policy))


def min_url_length(df: DataFrame, n: int = 10, url: str = "url") -> DataFrame:
    return df.filter(F.length(url) >= n)


def deny_domains(
    df: DataFrame,
    policy: DenyPolicy | DataFrame = DenyPolicy(),
    url: str = "url",
    salts: int = 32,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Drop links to denied domains.

    A ``DenyPolicy`` is a plain filter.  A policy table ``(pattern, match_kind)`` of at most
    ``broadcast_rows`` rows (by default ``BROADCAST_ROWS``) is anti-joined map-side, once per label count it holds.  A larger
    one is joined with the suffixes of the distinct hosts, and the links are anti-joined with
    the denied hosts; both sides are salted, so a host with a third of all links is spread.
    """
    if isinstance(policy, DenyPolicy):
        return df.filter(~is_denied_domain(F.col(url), policy))

    patterns = policy.select("pattern", "match_kind").distinct()
    links = df.withColumn("_host", url_host(F.col(url)))
    exact = patterns.filter("match_kind = 'host'").select(F.col("pattern").alias("_host"))
    below = patterns.filter("match_kind = 'registered'")
    if has_at_most(patterns, BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        links = links.join(F.broadcast(exact), "_host", "left_anti")
        depth = F.size(F.split("pattern", r"\.", -1))
        for (labels,) in below.select(depth).distinct().collect():
            tails = below.filter(depth == labels).select(F.col("pattern").alias("_tail"))
            links = links.withColumn("_tail", F.substring_index("_host", ".", -labels))
            links = links.join(F.broadcast(tails), "_tail", "left_anti").drop("_tail")
        return links.drop("_host")

    # Most suffixes ("com") are on no list but shared by many hosts: unmatched ones go first, and
    # both joins that a popular suffix or host takes part in are salted.
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    hosts = links.select("_host").filter("_host is not null").distinct()
    tries = hosts.select("_host", F.explode(host_suffixes(F.col("_host"))).alias("pattern"))
    matched = below.select("pattern").join(tries.select("pattern").distinct(), "pattern", "left_semi")
    tries = tries.withColumn("_salt", F.pmod(F.xxhash64("_host"), F.lit(salts)).cast("int"))
    found = tries.join(matched.withColumn("_salt", salt), ["pattern", "_salt"], "left_semi")
    denied = found.select("_host").union(exact).distinct().withColumn("_salt", salt)
    # By the row, not by its URL: one URL may hold a third of all rows.
    row = F.monotonically_increasing_id()
    links = links.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    return links.join(denied, ["_host", "_salt"], "left_anti").drop("_host", "_salt")


# --- submission records --------------------------------------------------------------------


def parse_submissions(
    df: DataFrame, policy: DenyPolicy = DenyPolicy(), min_karma: int = 3, value: str = "value"
) -> DataFrame:
    """Add ``url, score, over_18, status`` to lines that should hold one JSON object each.

    ``status`` is ``hit`` for a saved link; ``undecodable`` for a line that is no JSON object;
    ``domain``, ``extension``, ``length``, ``karma`` or ``adult`` for a record some test drops;
    ``bad_url``, ``bad_score`` or ``bad_over_18`` if a field that is needed next is missing or
    has the wrong type.  Fields behind the test that drops a record are not looked at.
    """
    # The line is parsed next to a second element that carries a mark: junk after the object, a
    # second object, a blank line or an array closed by the line break the array, its size or the
    # place of the mark.
    closed = F.concat(F.lit("["), F.col(value), F.lit(f',{{"_end":"{_END}"}}]'))
    parsed = F.from_json(closed, _RECORD, {"allowSingleQuotes": "false"})
    arrays = df.withColumn("_a", F.when(F.is_valid_utf8(F.col(value)), parsed))
    marked = (F.size("_a") == 2) & (F.get("_a", F.lit(1))["_end"] == _END)
    record = F.when(marked, F.col("_a")[0])
    fields = computed_once(arrays, {"_r": record})

    def kind(name):
        return F.coalesce(F.schema_of_variant(F.col(f"_r.{name}")), F.lit(""))

    def get(name, as_type):
        return F.try_variant_get(F.col(f"_r.{name}"), "$", as_type)

    number = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*|BOOLEAN)$"
    typed = computed_once(
        fields,
        {
            "url": F.when(kind("url") == "STRING", get("url", "string")),
            "score": F.when(kind("score").rlike(number), get("score", "double")),
            "over_18": _truthy(kind("over_18"), get("over_18", "string")),
        },
    )
    after_vetting = (
        F.when(F.col("score").isNull(), "bad_score")
        .when(~passes_karma(F.col("score"), min_karma), "karma")
        .when(F.col("over_18").isNull(), "bad_over_18")
        .when(F.col("over_18"), "adult")
        .otherwise("hit")
    )
    status = (
        F.when(F.col("_r").isNull(), "undecodable")
        .when(F.col("url").isNull(), "bad_url")
        .otherwise(F.coalesce(reject_reason(F.col("url"), policy), after_vetting))
    )
    return typed.select(*df.columns, "url", "score", "over_18", status.alias("status"))


def _truthy(kind: Column, text: Column) -> Column:
    """JSON truth: null, false, zero and empty values are false; null only if missing."""
    return (
        F.when(kind == "", None)
        .when(kind == "VOID", False)
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(text.try_cast("double") != 0)
    )


def passes_karma(score: Column, min_karma: int = 3) -> Column:
    # Spark orders NaN above every number; no comparison with it holds here.
    return (score > min_karma - 1) & ~F.isnan(score)


def min_karma(df: DataFrame, n: int = 3, score: str = "score") -> DataFrame:
    return df.filter(passes_karma(F.col(score), n))


def drop_over18(df: DataFrame, over_18: str = "over_18") -> DataFrame:
    return df.filter(~F.coalesce(F.col(over_18), F.lit(False)))


REJECTS = ("undecodable", "bad_url", "bad_score", "bad_over_18")


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Saved links, and the lines that could not be judged."""
    return parsed.filter("status = 'hit'"), parsed.filter(F.col("status").isin(*REJECTS))


def submission_stats(parsed: DataFrame, by: str = "src_file") -> DataFrame:
    """Lines, saved links, undecodable lines and percent saved per dump."""
    counts = parsed.groupBy(by).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("status") == "hit").alias("n_hits"),
        F.count_if(F.col("status").isin(*REJECTS)).alias("n_errors"),
    )
    return counts.withColumn("percent_saved", percent(F.col("n_hits"), F.col("n_lines")))


def reject_reasons(df: DataFrame, column: str = "reject_reason") -> DataFrame:
    """Links per reason; good ones under ``kept``."""
    reason = F.coalesce(F.col(column), F.lit("kept")).alias(column)
    return df.groupBy(reason).agg(F.count("*").alias("n_links"))


# --- crawl log and index pages -------------------------------------------------------------


def html_responses(df: DataFrame) -> DataFrame:
    """Crawl log rows that answered 200 with an HTML content type."""
    return df.filter((F.col("status") == 200) & F.col("content_type").contains("text/html"))


def links_with_prefix(df: DataFrame, prefix: str = "./", link: str = "link") -> DataFrame:
    return df.filter(F.col(link).startswith(prefix))


def distinct_links(df: DataFrame, link: str = "link") -> DataFrame:
    return df.select(link).distinct()
