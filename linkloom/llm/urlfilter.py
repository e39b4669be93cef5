"""URL verdicts: rules by host and path, then a list of URLs behind a blocked Bloom filter.

All of it is DataFrame functions.  The filter is a table of blocks of 256 bits, sized by the list, so
that about one URL in four hundred passes by mistake.  It is broadcast where it is small, and joined by
block where it is not.  URLs whose bits are all set go to an exact hash join with the list, which removes
the false positives; the others are decided without meeting the list.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import written

#: Listed URLs for each block of 256 bits, of which each sets four.
PER_BLOCK = 16
#: Blocks, of 40 bytes, that are broadcast at most.
BROADCAST_BLOCKS = 1 << 18
_WORDS = 4


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def _tracks(parameter: Column) -> Column:
    """Whether a parameter tells where a visitor came from, not which page is meant."""
    return F.startswith(parameter, F.lit("utm_")) | (F.substring_index(parameter, "=", 1) == "ref")


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, path without ``.html`` and the last slash, query without tracking.

    Parameters go as a whole: ``refresh`` is not ``ref``.  Empty ones go as well.

    Scheme and fragment do not count.  Null for a url that is null or has no ``://``.
    """
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"(\.html|/)$", "")
    raw = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    told = F.filter(F.split(raw, "&", -1), lambda p: (p != "") & ~_tracks(p))
    query = F.array_join(told, "&")
    full = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, full)


def _bits(canonical: Column, blocks: int) -> list[Column]:
    """The block, and one bit for each of its words."""
    second = F.xxhash64(canonical, F.lit("bits"))
    bit = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)) for i in range(_WORDS)]
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int")) for b in bit]
    return [F.pmod(F.xxhash64(canonical), F.lit(blocks)), *masks]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0 .. w3`` of the listed canonical URLs (column ``canonical``)."""
    block, *masks = _bits(F.col("canonical"), blocks)
    rows = listed.select(
        block.alias("block"), *(m.alias(f"m{i}") for i, m in enumerate(masks))
    )
    return rows.groupBy("block").agg(*(F.bit_or(f"m{i}").alias(f"w{i}") for i in range(_WORDS)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits.

    Rules are (verdict, host, path) and fit the host, its subdomains and paths that start so.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is outermost
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], per_block: int = PER_BLOCK
) -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical, listed``, one row per row of ``pages``.

    The verdict is the longest fitting rule's; without one, listed URLs (``listed.url``, compared in
    canonical form) are blocked and all others allowed, also null, empty and unparsable ones.  Repeats
    in the list do not repeat pages.  An empty list allows; an empty table gives no rows.  Columns
    other than ``page_id`` and ``url`` are not read.
    """
    wanted = listed.select(canonical_url(F.col("url")).alias("canonical")).where("canonical is not null")
    wanted = written(wanted.distinct())
    blocks = max(1, -(-wanted.count() // per_block))
    bloom = bloom_blocks(wanted, blocks)
    url = F.col("url")
    rows = pages.select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"),
        canonical_url(url).alias("canonical"),
    )
    block, *masks = _bits(F.col("canonical"), blocks)
    probed = rows.withColumn("block", block).join(
        F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block", "left"
    )
    inside = F.lit(True)
    for i, mask in enumerate(masks):
        inside = inside & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    inside = F.coalesce(inside & F.col("canonical").isNotNull(), F.lit(False))
    flagged = probed.select("page_id", "host", "path", "canonical", inside.alias("__possible"))
    exact = wanted.withColumn("__hit", F.lit(True))
    possible = flagged.where("__possible").join(exact, "canonical", "left")
    rest = flagged.where("not __possible").withColumn("__hit", F.lit(False))
    judged = possible.unionByName(rest)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    hit = F.coalesce("__hit", F.lit(False))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(hit, "block").otherwise("allow")).alias("verdict"),
        "canonical", hit.alias("listed"),
    )
