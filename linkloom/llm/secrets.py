"""Secrets: fixed formats, and tokens that a battery of randomness tests takes for random.

The battery looks at runs of characters that encodings are made of.  For each, an encoding is inferred
(the smallest alphabet that holds it; a run is also tested in its parts between signs), and three tests of randomness are made over that alphabet:
chi-squared uniformity of the symbols, the number of runs above and below the middle of the alphabet,
and the serial correlation of neighbours.  Fisher's method combines them: a random token passes.

Short tokens of ordinary writing pass too, as short tokens prove little.  So a token is reported only
if ordinary writing of its length would hardly look so even.  Ordinary writing repeats symbols: with
the shares that the alphabet's symbols have in the corpus, the number of equal pairs in a token of
length n has a known mean and variance, and its p-value is the chance of as few equal pairs.  The p-values are judged by
encoding and length class with the rule of Benjamini and Hochberg, so that the many short tokens are
held to a stricter bound and at most about a share of ``rate`` of the reports are ordinary writing.
"""

from __future__ import annotations

import math
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import Intervals, values, written

#: Kinds in the order in which equal starts are listed; ``random`` is the battery's.
KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
RATE, ALPHA = 0.01, 0.001
#: p-values are counted in bins of an eighth of a decade, down to 1e-30.
BINS_PER_DECADE, DECADES = 8, 30

# The formats (fixed values).
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN)
_CUTS = [
    re.compile("[%s]{%d,}" % (own, MIN_TOKEN)) for own in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9+", "A-Za-z0-9")
]

# Alphabets from small to large; the first that holds all of a token's symbols is its encoding.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": _UPPER + "234567",
    "lower": _LOWER,
    "upper36": "0123456789" + _UPPER,
    "lower36": "0123456789" + _LOWER,
    "letters": _UPPER + _LOWER,
    "base62": "0123456789" + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + "0123456789+/",
    "base64url": _UPPER + _LOWER + "0123456789-_",
}
_PLACES = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ALPHABETS.items()}
_SETS = {name: frozenset(symbols) for name, symbols in ALPHABETS.items()}


def formats(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return found


def encoding_of(token: str) -> str | None:
    symbols = set(token)
    return next((name for name, own in _SETS.items() if symbols <= own), None)


def _normal_tail(z: float) -> float:
    """P(Z >= z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def equal_pairs(counts) -> int:
    return sum(c * (c - 1) // 2 for c in counts)


def pair_moments(n: int, squares: float, cubes: float) -> tuple[float, float]:
    """Mean and variance of the equal pairs among n independent symbols with these power sums."""
    pairs = n * (n - 1) / 2
    threes = n * (n - 1) * (n - 2)
    return pairs * squares, pairs * squares * (1 - squares) + threes * (cubes - squares * squares)


def battery(token: str, encoding: str) -> float:
    """Combined p-value of the hypothesis that the token is random over its alphabet."""
    places = _PLACES[encoding]
    x = [places[c] for c in token]
    n, size = len(x), len(places)
    counts: dict[int, int] = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    # Chi-squared against uniform is linear in the number of equal pairs; exact moments of that.
    mean, var = pair_moments(n, 1 / size, 1 / size**2)
    p_chi = _normal_tail((equal_pairs(counts.values()) - mean) / math.sqrt(var))
    # Runs: places in the lower and the upper half of the alphabet.
    high = [2 * v >= size for v in x]
    share = (size // 2) / size
    change = 2 * share * (1 - share)
    turns = sum(a != b for a, b in zip(high, high[1:]))
    var = (n - 1) * change * (1 - change) + 2 * (n - 2) * (change / 2 - change * change)
    p_runs = 2 * _normal_tail(abs(turns - (n - 1) * change) / math.sqrt(var))
    # Serial correlation at lag one, around the alphabet's own mean and variance.
    middle, spread = (size - 1) / 2, (size * size - 1) / 12
    lag = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:])) / spread
    p_serial = 2 * _normal_tail(abs(lag) / math.sqrt(n - 1))
    # Fisher: minus twice the log of the product has a chi-squared distribution with 6 degrees.
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def writing_p(n: int, pairs: int, squares: float, cubes: float) -> float:
    """Chance that n symbols of ordinary writing have as few equal pairs."""
    mean, var = pair_moments(n, squares, cubes)
    return _normal_tail((mean - pairs - 0.5) / math.sqrt(var)) if var > 0 else 1.0


def length_class(n: int) -> int:
    """Classes that widen by a quarter."""
    return int(math.log(n) / math.log(1.25))


def token_ranges(token: str) -> list[tuple[int, int]]:
    """The token and its parts of MIN_TOKEN characters or more, the widest first.

    A secret may be joined to other things by signs that stand in one alphabet and not in another, so
    the parts are those without the signs of base64url, without those of base64, and without all.
    """
    found = {(0, len(token))}
    for cut in _CUTS:
        found.update(m.span() for m in cut.finditer(token))
    return sorted(found, key=lambda r: (r[0] - r[1], r[0]))


def candidates(text: str) -> list[tuple[int, int, str, int, bool]]:
    """(start, end, encoding, equal pairs, looks random) of the tokens put to the test.

    Tokens of one run overlap; a run's wider ones come first.
    """
    found = []
    for m in _TOKEN.finditer(text):
        run = m[0].rstrip("=")
        for a, b in token_ranges(run):
            token = run[a:b]
            encoding = encoding_of(token)
            if encoding is None:
                continue
            counts: dict[str, int] = {}
            for c in token:
                counts[c] = counts.get(c, 0) + 1
            fits = battery(token, encoding) >= ALPHA
            end = m.end() if b == len(run) else m.start() + b
            found.append((m.start() + a, end, encoding, equal_pairs(counts.values()), fits))
    return found


_SPAN = "array<struct<start:long,end:long,kind:string>>"
_TEST = "array<struct<start:long,end:long,encoding:string,n:long,pairs:long,fits:boolean>>"
_FOUND = f"doc_id long, base {_SPAN}, tests {_TEST}, letters array<long>"
_SPAN_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
)
_TEST_TYPE = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("n", pa.int64()),
         ("pairs", pa.int64()), ("fits", pa.bool_())]
    )
)


def _find(batches):
    """The spans and tests of each text.  The last row of a batch carries its letter counts."""
    for batch in batches:
        base, tests = [], []
        letters = np.zeros(256, np.int64)
        for text in values(batch, "text"):
            text = text or ""
            letters += np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
            base.append([dict(start=a, end=b, kind=k) for a, b, k in formats(text)])
            tests.append(
                [
                    dict(start=a, end=b, encoding=e, n=len(text[a:b].rstrip("=")), pairs=p, fits=f)
                    for a, b, e, p, f in candidates(text)
                ]
            )
        counts = [None] * len(base)
        if counts:
            counts[-1] = letters.tolist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(base, _SPAN_TYPE), pa.array(tests, _TEST_TYPE),
                pa.array(counts, pa.list_(pa.int64())),
            ],
            ["doc_id", "base", "tests", "letters"],
        )


def power_sums(counts: list[int]) -> dict[str, tuple[float, float]]:
    """For each encoding, the sums of squares and cubes of its symbols' shares in the corpus."""
    sums = {}
    for name, symbols in ALPHABETS.items():
        own = [counts[ord(c)] + 1 for c in symbols]  # a count of one more keeps shares defined
        n = sum(own)
        sums[name] = sum((c / n) ** 2 for c in own), sum((c / n) ** 3 for c in own)
    return sums


def corpus_counts(found: DataFrame) -> list[int]:
    """How often each byte below 128 stands in the corpus, summed by Spark."""
    total = found.where("letters is not null").agg(
        *(F.sum(F.col("letters")[c]).alias(f"c{c}") for c in range(128))
    ).first()
    return [x or 0 for x in total]


def _bin(p: float) -> int:
    return min(BINS_PER_DECADE * DECADES, int(-math.log10(max(p, 1e-300)) * BINS_PER_DECADE))


def _p_bins(sums: dict):
    def run(batches):
        for batch in batches:
            strata, bins = [], []
            for tests in values(batch, "tests"):
                for t in tests:
                    strata.append(f"{t['encoding']}/{length_class(t['n'])}")
                    bins.append(_bin(writing_p(t["n"], t["pairs"], *sums[t["encoding"]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(strata, pa.string()), pa.array(bins, pa.int64())], ["stratum", "bin"]
            )

    return run


def bin_bounds(counts: list[tuple[str, int, int]], rate: float) -> dict[str, int]:
    """Benjamini and Hochberg within each stratum, on counts by bin: the least bin that is reported.

    A bin counts with its largest p-value, which is on the safe side.
    """
    by_stratum: dict[str, dict[int, int]] = {}
    for stratum, b, n in counts:
        by_stratum.setdefault(stratum, {})[b] = n
    bounds = {}
    for stratum, bins in by_stratum.items():
        total, above = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b / BINS_PER_DECADE) * total <= rate * above:
                bounds[stratum] = b
    return bounds


def _report(sums: dict, bounds: dict[str, int]):
    def run(batches):
        for batch in batches:
            out = []
            for doc_id, base, tests in zip(*(values(batch, x) for x in ("doc_id", "base", "tests"))):
                spans = [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in base]
                taken = Intervals((a, b) for a, _, b in spans)
                for t in tests:
                    bound = bounds.get(f"{t['encoding']}/{length_class(t['n'])}")
                    p = writing_p(t["n"], t["pairs"], *sums[t["encoding"]])
                    inside = taken.touches(t["start"], t["end"])
                    if t["fits"] and bound is not None and _bin(p) >= bound and not inside:
                        spans.append((t["start"], 3, t["end"]))
                        taken.add(t["start"], t["end"])
                spans.sort()
                line = lambda own: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in own)
                kinds = [k for _, k, _ in spans]
                plain = [s for s in spans if s[1] < 3]
                out.append(
                    (doc_id, *(kinds.count(k) for k in range(3)),
                     sha256(line(plain).encode()).hexdigest(), line(spans), kinds.count(3))
                )
            columns = zip(*out) if out else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
            )

    return run


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random``, one row per row of ``docs``.

    ``spans`` lists ``kind:start:end`` in code points, by start and then kind; ``n_random`` of them come
    from the battery and touch no span of a fixed format.  Null and empty texts have none.  The symbol
    shares and the bounds come from the whole table; a bound is set for each encoding and length class,
    so that long runs of one class leave the others alone.  Repeated rows are found alike, and an empty
    table gives no rows.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    start = docs.select(F.col("doc_id").cast("long"), "text")
    found = written(start.mapInArrow(_find, _FOUND))
    sums = power_sums(corpus_counts(found))
    tested = found.where(F.size("tests") > 0).select("tests")
    counted = tested.mapInArrow(_p_bins(sums), "stratum string, bin long")
    # Encodings times length classes times bins: a few thousand rows whatever the input.
    counts = counted.groupBy("stratum", "bin").count().collect()
    bounds = bin_bounds([tuple(r) for r in counts], rate)
    return found.select("doc_id", "base", "tests").mapInArrow(
        _report(sums, bounds),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string,"
        " n_random long",
    )
