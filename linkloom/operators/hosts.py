"""Hosts split into subdomain, registered domain and public suffix, by a caller's table of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import host_suffixes, url_host
from linkloom.operators.links import BROADCAST_ROWS
from linkloom.session import has_at_most

# Four decimal numbers up to 255: an address, which has no suffix.
_NUMBER = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
ADDRESS = rf"^{_NUMBER}(?:\.{_NUMBER}){{3}}$"


def suffix_rules(rules: DataFrame, rule: str = "rule") -> DataFrame:
    """Rules as ``(tail, depth, plain, wild, exempt)``, one row per tail of ``depth`` labels.

    ``co.uk`` names a suffix, ``*.ck`` every name right below ``ck``, and ``!www.ck`` takes one out
    again.  A rule ends at white space; blank lines and lines that start with ``//`` are no rules.
    """
    text = F.lower(F.regexp_extract(rule, r"^\s*(\S+)", 1))
    given = rules.select(text.alias("_r")).filter((F.col("_r") != "") & ~F.col("_r").startswith("//"))
    wild, exempt = F.col("_r").startswith("*."), F.col("_r").startswith("!")
    kinds = given.select(
        F.regexp_replace("_r", r"^(?:\*\.|!)", "").alias("tail"),
        (~wild & ~exempt).alias("plain"), wild.alias("wild"), exempt.alias("exempt"),
    )
    flags = kinds.groupBy("tail").agg(*[F.bool_or(k).alias(k) for k in ("plain", "wild", "exempt")])
    return flags.withColumn("depth", F.size(F.split("tail", r"\.", -1)))


def _claims(kinds: Column, depth: Column, labels: Column) -> list[Column]:
    """Labels of the suffix by an exception, and by the other rules of one tail; null if none."""
    by_wild = F.when(kinds["wild"] & (labels > depth), depth + 1)
    return [F.when(kinds["exempt"], depth - 1), F.coalesce(by_wild, F.when(kinds["plain"], depth))]


def with_host_parts(
    df: DataFrame,
    rules: DataFrame,
    url: str = "url",
    name: str = "host_parts",
    salts: int = 32,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Add STRUCT<subdomain, domain, suffix, registered_domain, host>; null for a null URL.

    The longest suffix that a rule gives wins, and an exception wins over all others.  Without a rule,
    and for IPv4 addresses, the suffix is empty and the domain is the last label or the address; a host
    that is a suffix itself has no domain.  ``registered_domain`` is empty unless both are there.  Case
    does not matter to the rules and stays in the parts.

    Rules of at most ``broadcast_rows`` rows (by default ``BROADCAST_ROWS``) are looked up map-side, once
    per label count that they hold.  Larger ones meet the distinct hosts only, and what these have is
    joined on; both joins are salted, so that ``com`` and a host with a third of all rows are spread.
    """
    compiled = suffix_rules(rules)
    labels = F.size(F.split("_host", r"\.", -1))
    hosts = df.withColumn("_host", url_host(F.col(url)))
    if has_at_most(compiled, BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        exempt, listed = [], []
        for (depth,) in sorted(compiled.select("depth").distinct().collect()):
            tails = compiled.filter(F.col("depth") == depth).select(
                F.col("tail").alias("_tail"), F.struct("plain", "wild", "exempt").alias("_kinds")
            )
            hosts = hosts.withColumn("_tail", F.substring_index(F.lower("_host"), ".", -depth))
            hosts = hosts.join(F.broadcast(tails), "_tail", "left").drop("_tail")
            names = f"_exempt{depth}", f"_listed{depth}"
            claims = _claims(F.col("_kinds"), F.lit(depth), labels)
            hosts = hosts.withColumns(dict(zip(names, claims))).drop("_kinds")
            exempt.append(names[0])
            listed.append(names[1])
        # An array each, as there may be one column or none.
        by_exempt = F.array_max(F.array(F.lit(None).cast("int"), *exempt))
        size = F.coalesce(by_exempt, F.array_max(F.array(F.lit(0), *listed)))
        sized = hosts.withColumn("_size", size).drop(*exempt, *listed)
    else:
        sized = _joined_sizes(hosts, compiled, salts)

    # An address is one label with no suffix.
    address = F.col("_host").rlike(ADDRESS)
    pieces = F.when(address, F.array("_host")).otherwise(F.split("_host", r"\.", -1))
    dealt = sized.withColumns({"_pieces": pieces, "_size": F.when(address, 0).otherwise(F.col("_size"))})
    front, one = F.size("_pieces") - F.col("_size"), F.lit(1)

    def joined(start: Column, n: Column) -> Column:
        return F.array_join(F.slice("_pieces", start, F.greatest(n, F.lit(0))), ".")

    parts = dealt.withColumns({
        "_under": joined(one, front - 1),
        "_domain": F.when(front > 0, F.get("_pieces", front - 1)).otherwise(""),
        "_suffix": joined(front + 1, F.col("_size")),
    })
    both = (F.col("_domain") != "") & (F.col("_suffix") != "")
    registered = F.when(both, F.concat("_domain", F.lit("."), "_suffix")).otherwise("")
    found = F.struct(
        F.col("_under").alias("subdomain"), F.col("_domain").alias("domain"),
        F.col("_suffix").alias("suffix"), registered.alias("registered_domain"), F.col("_host").alias("host"),
    )
    return parts.select(
        *[c for c in df.columns if c != name], F.when(F.col("_host").isNotNull(), found).alias(name)
    )


def _joined_sizes(hosts: DataFrame, compiled: DataFrame, salts: int) -> DataFrame:
    """``_size`` by joins that broadcast nothing."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    tails = host_suffixes(F.lower("_host"))
    tries = hosts.select("_host").filter("_host is not null").distinct().select(
        "_host", F.size(F.split("_host", r"\.", -1)).alias("_labels"), F.explode(tails).alias("tail")
    )
    kinds = compiled.select("tail", "depth", F.struct("plain", "wild", "exempt").alias("_kinds"))
    met = kinds.join(tries.select("tail").distinct(), "tail", "left_semi").withColumn("_salt", salt)
    tries = tries.withColumn("_salt", F.pmod(F.xxhash64("_host"), F.lit(salts)).cast("int"))
    exempt, listed = _claims(F.col("_kinds"), F.col("depth"), F.col("_labels"))
    sizes = tries.join(met, ["tail", "_salt"]).groupBy("_host").agg(
        F.coalesce(F.max(exempt), F.max(listed), F.lit(0)).alias("_size")
    )
    # By the row, not by its host: one host may hold a third of all rows.
    row = F.monotonically_increasing_id()
    dealt = hosts.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    found = dealt.join(sizes.withColumn("_salt", salt), ["_host", "_salt"], "left")
    return found.withColumn("_size", F.coalesce("_size", F.lit(0))).drop("_salt")
