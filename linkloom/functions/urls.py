"""URL parsing, canonical forms and dedup keys, all JVM-side."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemes whose last path segment may carry ;params (fixed values).
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp",
    "rtsp", "rtsps", "sip", "sips", "mms", "sftp", "tel",
)


def _after(text: Column, mark: str) -> Column:
    """Text after the first ``mark``; empty if there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + 1)).otherwise("")


# White space and control characters that may precede a URL (fixed values).
_LEADING = "".join(map(chr, range(0x21)))


def _url_text(url: Column) -> Column:
    """URL without leading blanks and without tabs and line ends anywhere."""
    text = F.ltrim(url, F.lit(_LEADING))
    for mark in "\t\r\n":
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


@lru_cache(maxsize=1)
def _unparsable_pattern() -> str:
    """A host with one kind of square bracket only, or with a character whose compatibility
    form holds a URL delimiter."""
    unsafe = "".join(
        f"\\x{{{c:x}}}"
        for c in range(0x80, 0x10000)
        if not 0xD800 <= c < 0xE000
        and set(unicodedata.normalize("NFKC", chr(c))) & set("/?#@:")
    )
    opened = r"[^/?#\[\]]*\[[^/?#\]]*(?:[/?#]|\z)"
    closed = r"[^/?#\[\]]*\][^/?#\[]*(?:[/?#]|\z)"
    return rf"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:{opened}|{closed}|[^/?#]*[{unsafe}])"


def is_parsable(url: Column) -> Column:
    """False for URLs the parser rejects, null for null.

    Only URLs with brackets or characters beyond ASCII meet the pattern.
    """
    plain = ~url.contains("[") & ~url.contains("]") & (F.length(url) == F.octet_length(url))
    return F.when(plain, True).otherwise(~_url_text(url).rlike(_unparsable_pattern()))


def decode_component(text: Column) -> Column:
    """``%XX`` and ``+`` decoded; a percent sign that starts no escape stays as it is."""
    safe = F.when(
        text.contains("%"), F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    ).otherwise(text)
    escaped = text.contains("%") | text.contains("+")
    return F.when(escaped, F.try_url_decode(safe)).otherwise(text)


def decode_path(path: Column) -> Column:
    return decode_component(path)


def _query_set(query: Column, build, kind: str) -> Column:
    """Sorted distinct array of ``build(key, value)``; pairs with blank values are dropped."""

    def pairs(decode):
        return F.transform(
            given,
            lambda p: build(
                decode(F.substring_index(p, "=", 1)), decode(F.substr(p, F.instr(p, "=") + 1))
            ),
        )

    given = F.filter(
        F.split(query, "&", -1),
        lambda p: (F.instr(p, "=") > 0) & (F.length(p) > F.instr(p, "=")),
    )
    escaped = query.contains("%") | query.contains("+")
    found = F.when(escaped, pairs(decode_component)).otherwise(pairs(lambda text: text))
    several = F.when(query.contains("&"), F.sort_array(F.array_distinct(found))).otherwise(found)
    return F.when(query.contains("="), several).when(
        query.isNotNull(), F.array().cast(f"array<{kind}>")
    )


def canonical_query(query: Column) -> Column:
    """Decoded key/value pairs, sorted and distinct; blank values dropped."""
    return _query_set(
        query, lambda k, v: F.struct(k.alias("k"), v.alias("v")), "struct<k string, v string>"
    )


def _query_key(query: Column) -> Column:
    """The same set as one string; each part carries its length."""

    def sized(text):
        return F.concat(F.length(text).cast("string"), F.lit(":"), text)

    pairs = _query_set(query, lambda k, v: F.concat(sized(k), sized(v)), "string")
    return F.array_join(pairs, "")


def with_url_parts(df: DataFrame, url: str = "url", name: str = "parts") -> DataFrame:
    """Add STRUCT<scheme, netloc, path, params, query, fragment>, undecoded; null if unparsable.

    Every step is a projection of its own, as each piece is used by several later ones; the
    optimizer keeps such steps apart, so the compiled code stays short.
    """
    c = F.col
    steps = (
        {"_text": _url_text(c(url))},
        {"_whole": F.substring_index("_text", "#", 1), "_fragment": _after(c("_text"), "#")},
        {"_base": F.substring_index("_whole", "?", 1), "_query": _after(c("_whole"), "?")},
        {"_scheme": F.regexp_extract("_base", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)},
        {"_rest": F.when(c("_scheme") == "", c("_base")).otherwise(
            F.substr("_base", F.length("_scheme") + 2))},
        {"_netloc": F.when(c("_rest").startswith("//"), F.substring_index(
            F.substr("_rest", F.lit(3)), "/", 1))},
        {"_full": F.when(c("_netloc").isNull(), c("_rest")).otherwise(
            F.substr("_rest", F.length("_netloc") + 3)), "_scheme": F.lower("_scheme")},
        {"_segment": F.substring_index("_full", "/", -1)},
        {"_semi": F.when(c("_scheme").isin(*PARAM_SCHEMES), F.instr("_segment", ";")).otherwise(0)},
        {"_params": F.when(c("_semi") > 0, F.substr("_segment", c("_semi") + 1)).otherwise(""),
         "_path": F.when(c("_semi") > 0, F.substr("_full", F.lit(1),
             F.length("_full") - F.length("_segment") + c("_semi") - 1)).otherwise(c("_full")),
         "_netloc": F.coalesce("_netloc", F.lit(""))},
    )
    out = df
    for step in steps:
        out = out.withColumns(step)
    fields = ("scheme", "netloc", "path", "params", "query", "fragment")
    parts = F.when(is_parsable(c(url)), F.struct(*[c(f"_{f}").alias(f) for f in fields]))
    return out.select(*[k for k in df.columns if k != name], parts.alias(name))


def with_url_key(
    df: DataFrame, mode: str = "full", url: str = "url", name: str = "url_key"
) -> DataFrame:
    """Add one string per class of equal URLs; null for unparsable ones.

    ``full``: two URLs are equal when all six parts agree.  ``host_path``: host and path only.
    The first four parts cannot hold a newline, and decoded parts carry their lengths, so
    different part tuples never share a key.
    """
    if mode not in ("full", "host_path"):
        raise ValueError(f"unknown key mode: {mode}")
    p = F.col("_parts")
    keys = {
        "host_path": F.concat(p["netloc"], F.lit("\n"), F.col("_decoded")),
        "full": F.concat(
            p["scheme"], F.lit("\n"), p["netloc"], F.lit("\n"),
            p["params"], F.lit("\n"), p["fragment"], F.lit("\n"),
            F.length("_decoded").cast("string"), F.lit(":"), "_decoded", "_pairs",
        ),
    }
    parsed = with_url_parts(df, url, "_parts").withColumns(
        {"_decoded": decode_path(p["path"]), "_pairs": _query_key(p["query"])}
    )
    return parsed.select(*[k for k in df.columns if k != name], keys[mode].alias(name))


def url_host(url: Column) -> Column:
    """Host name without user, port and trailing dots; the scheme is optional."""
    rest = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    for mark in ("/", "?", "#"):
        rest = F.substring_index(rest, mark, 1)
    host = F.substring_index(F.substring_index(rest, "@", -1), ":", 1)
    return F.rtrim(F.trim(host), F.lit("."))


def host_suffixes(host: Column) -> Column:
    """Every dot-suffix of a host, the host itself first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
