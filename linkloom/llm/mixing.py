"""Mixing by soft membership: document rates whose expected domain totals match target weights.

A classifier, fitted on a labelled table, gives each document a posterior over the domains.  Its tokens
count towards each domain by that share.  Rates start at one and follow projected gradient steps of the
least-squares distance between expected domain totals and targets.  The residuals are weighed by the
domains' own token mass and the rates by the documents' tokens; in these units the problem's matrix has
rows that sum to one, so a step of one is never too long, and the step of a document depends on its
posterior alone.  A rate is therefore replayed from the residuals so far, of which there is one short
vector for each step: nothing is stored for documents, and a step is one sum over the table.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import values, written

#: Labelled documents that the classifier learns from; their ids are broadcast (20 bytes each).
SAMPLE_ROWS = 8_000
#: Hash buckets of features, and how many of them the model uses.
BUCKETS, TELLING = 1 << 16, 2048
FIT_STEPS, PENALTY = 200, 3e-4
STEPS, TOLERANCE = 60, 1e-6
_EVIDENCE = 4.0

# Letters, digits and signs by class; a word's shape is this with repeats collapsed.
_CLASSES = bytes(
    ord("A") if chr(c).isupper() and c < 128 else ord("a") if c >= 128 or chr(c).isalpha()
    else ord("0") if 48 <= c <= 57 else c
    for c in range(256)
)


def _shape(classes: bytes) -> bytes:
    out = bytearray()
    for c in classes:
        if not out or out[-1] != c:
            out.append(c)
    return b"\x00" + bytes(out[:12])


def features(text: str | None, shapes: dict) -> tuple[int, set[int]]:
    """How many words, and the buckets of the words (A-Z lower-cased) and of their shapes."""
    raw = (text or "").encode()
    words = raw.lower().split()
    found = {xxhash.xxh32_intdigest(w) % BUCKETS for w in {w.strip(b".,;:!?\"'()") for w in words}}
    for classes in set(raw.translate(_CLASSES).split()):
        bucket = shapes.get(classes)
        if bucket is None:
            bucket = xxhash.xxh32_intdigest(_shape(classes)) % BUCKETS
            if len(shapes) < 100_000:  # a cache, nothing more
                shapes[classes] = bucket
        found.add(bucket)
    return len(words), found


def _sample_features(batches):
    shapes: dict = {}
    for batch in batches:
        found = [sorted(features(t, shapes)[1]) for t in values(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
            ["rank", "domain", "buckets"],
        )


class Classifier:
    """Multinomial logistic regression on the buckets that tell domains apart."""

    def __init__(self, domains: list[str], telling: list[int], rows: list[tuple[str, list[int]]]):
        self.domains = domains
        column = {b: i for i, b in enumerate(telling)}
        x = np.zeros((len(rows), len(telling) + 1), np.float32)
        x[:, -1] = 1
        y = np.zeros((len(rows), len(domains)), np.float32)
        for i, (domain, buckets) in enumerate(rows):
            x[i, [column[b] for b in buckets if b in column]] = 1
            y[i, domains.index(domain)] = 1
        w = np.zeros((x.shape[1], len(domains)), np.float32)
        first, second = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, FIT_STEPS + 1 if len(rows) else 1):
            p = _softmax(x @ w)
            g = x.T @ (p - y) / len(rows) + PENALTY * w
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            w -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        self.weights = {b: w[i].astype(float) for b, i in column.items()}
        self.prior = w[-1].astype(float)

    def posterior(self, found: set[int]) -> np.ndarray:
        score = self.prior.copy()
        for bucket in sorted(self.weights.keys() & found):
            score += self.weights[bucket]
        return _softmax(score)


def _softmax(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def telling_buckets(counts: dict[tuple[str, int], int], docs: dict[str, int], most: int) -> list[int]:
    """The buckets whose share of documents differs most between domains, for its chance spread."""
    by_bucket: dict[int, int] = {}
    for (_, bucket), n in counts.items():
        by_bucket[bucket] = by_bucket.get(bucket, 0) + n
    total = sum(docs.values())
    away = {}
    for bucket, n in by_bucket.items():
        for domain, own in docs.items():
            expected = own * n / total
            z = abs(counts.get((domain, bucket), 0) - expected) / (expected + 1) ** 0.5
            away[bucket] = max(away.get(bucket, 0), z)
    ranked = sorted((b for b, z in away.items() if z > _EVIDENCE), key=lambda b: (-away[b], b))
    return ranked[:most]


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str],
                rows: int = SAMPLE_ROWS) -> Classifier:
    """Learn from documents with a row in ``labelled`` (``doc_id, domain``).

    The sample is the ``rows`` ids of smallest hash; an id with several domains counts for the least,
    and documents with the same features count once, so that groups of copies do not shape the model.
    The driver gets a count for each domain and bucket, and for each document of the sample the
    buckets among the ``TELLING`` chosen ones.
    """
    own = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    rank = F.xxhash64("__id").alias("rank")
    chosen = (
        own.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("domain").alias("domain"))
        .select("__id", rank, "domain").orderBy("rank", "__id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(
        F.broadcast(chosen), "__id"
    )
    each = texts.select("rank", "domain", "text").mapInArrow(
        _sample_features, "rank long, domain string, buckets array<long>"
    )
    sample = written(each.groupBy("domain", "buckets").agg(F.min("rank").alias("rank")))
    counted = sample.select("domain", F.explode("buckets").alias("bucket")).groupBy("domain", "bucket")
    counts = {(r.domain, r.bucket): r["count"] for r in counted.count().collect()}
    n_docs = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    telling = telling_buckets(counts, n_docs, TELLING)
    wanted = F.array_intersect("buckets", F.lit(telling).cast("array<long>"))
    found = sample.select("rank", "domain", wanted.alias("buckets")).collect()
    found.sort(key=lambda r: (r.rank, r.domain, r.buckets))
    return Classifier(domains, telling, [(r.domain, r.buckets) for r in found])


def _posteriors(model: Classifier):
    def run(batches):
        shapes: dict = {}
        for batch in batches:
            n_tokens, shares = [], []
            for text in values(batch, "text"):
                n, found = features(text, shapes)
                n_tokens.append(n)
                shares.append(model.posterior(found))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_tokens, pa.int64()), pa.array(shares, pa.list_(pa.float64()))],
                [*batch.schema.names, "__tokens", "__shares"],
            )

    return run


def with_posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with ``__tokens`` and the posterior ``__shares`` in the order of the domains."""
    schema = docs.select(
        "*", F.lit(0).cast("long").alias("__tokens"), F.array().cast("array<double>").alias("__shares")
    ).schema
    return docs.mapInArrow(_posteriors(model), schema)


def replay(shares: np.ndarray, residuals: list[np.ndarray], max_rate: float):
    """(rates, point of the next gradient) after as many projected steps as there are residuals.

    Steps are taken from a point ahead in the last direction (Nesterov), which in a handful of domains
    that the classifier partly confuses saves most of the steps.
    """
    rates = ahead = np.ones(len(shares))
    for k, r in enumerate(residuals):
        stepped = np.clip(ahead - shares @ r, 0, max_rate)
        ahead = stepped + k / (k + 3) * (stepped - rates)
        rates = stepped
    return rates, ahead


def _matrix(batch: pa.RecordBatch, n_domains: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("__shares"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_domains)


def _expected(residuals: list[np.ndarray], n_domains: int, max_rate: float, at_point: int):
    def run(batches):
        total = np.zeros(n_domains)
        for batch in batches:
            shares = _matrix(batch, n_domains)
            tokens = batch.column(batch.schema.get_field_index("__tokens")).to_numpy()
            total += (replay(shares, residuals, max_rate)[at_point] * tokens) @ shares
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i in range(n_domains)]), pa.array(total)], ["domain", "total"]
        )

    return run


def expected_totals(marked: DataFrame, residuals, n_domains: int, max_rate: float,
                    at_point: int = 0) -> np.ndarray:
    """Domain totals at the rates or, for a gradient, at the point ahead (1)."""
    parts = marked.select("__tokens", "__shares").mapInArrow(
        _expected(residuals, n_domains, max_rate, at_point), "domain long, total double"
    )
    totals = np.zeros(n_domains)
    for r in parts.groupBy("domain").agg(F.sum("total").alias("total")).collect():
        totals[r.domain] = r.total
    return totals


def solve(marked: DataFrame, weights: list[float], max_rate: float,
          total_of: int | None = None) -> list[np.ndarray]:
    """The residual of each step, by which any document's rate can be replayed.

    Targets are the weights' shares of the present token total or, with ``total_of``, of the total at
    which that domain keeps its present size.  It ends when all totals are met or no residual changes
    any more, which is the least-squares solution.  If neither is so after ``STEPS`` steps, a warning
    tells by how much the totals are off, and the rates of the last step hold.
    """
    n = len(weights)
    mass = expected_totals(marked, [], n, max_rate)
    share = np.array(weights, float) / sum(weights)
    whole = mass.sum() if total_of is None else mass[total_of] / share[total_of]
    target, scale = share * whole, np.maximum(mass, 1e-9 * max(1.0, mass.sum()))
    residuals: list[np.ndarray] = []
    totals = mass
    for _ in range(STEPS):
        # Rounded, so that the order in which partial sums arrive leaves no trace.
        residual = np.round((totals - target) / scale, 10)
        still = residuals and np.abs(residual - residuals[-1]).max() <= TOLERANCE
        if np.abs(residual).max() <= TOLERANCE or still:
            break
        residuals.append(residual)
        totals = expected_totals(marked, residuals, n, max_rate, at_point=1)
    else:
        left = np.abs((totals - target) / scale).max()
        warnings.warn(f"after {STEPS} steps a domain is off by {left:.2g} of its size", RuntimeWarning, stacklevel=2)
    return residuals


def _rates(residuals, n_domains: int, max_rate: float):
    def run(batches):
        for batch in batches:
            rates = replay(_matrix(batch, n_domains), residuals, max_rate)[0]
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(rates, pa.float64())], [*batch.schema.names, "__rate"]
            )

    return run


def with_rates(marked: DataFrame, residuals, n_domains: int, max_rate: float) -> DataFrame:
    schema = marked.select("*", F.lit(0.0).alias("__rate")).schema
    return marked.mapInArrow(_rates(residuals, n_domains, max_rate), schema)


def copies_of(rate: Column, *key: str) -> Column:
    """The rate rounded up or down, by a hash of the row, so that its mean is the rate."""
    uniform = F.pmod(F.xxhash64(F.lit("mix"), *key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + uniform).cast("long")


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
                 max_rate: float = 8.0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, source, n_tokens, p_<domain> ..., rate, copies``, one row per row of ``docs``.

    ``targets`` maps each domain to its weight.  Null and empty texts have no tokens and no say; they
    get the prior as posterior.  A target that no rates within ``max_rate`` can reach is approached in
    the sense of least squares.  Repeated rows get the same rate.  An empty table gives no rows, and
    without labelled rows all posteriors are equal.
    """
    domains = sorted(targets)
    model = fit_domains(docs, labelled, domains, rows)
    start = docs.select(F.col("doc_id").cast("long"), "source", "text")
    marked = written(with_posteriors(start, model).drop("text"))
    residuals = solve(marked, [targets[d] for d in domains], max_rate)
    rated = with_rates(marked, residuals, len(domains), max_rate)
    return rated.select(
        "doc_id", "source", F.col("__tokens").alias("n_tokens"),
        *(F.col("__shares")[i].alias(f"p_{d}") for i, d in enumerate(domains)),
        F.col("__rate").alias("rate"), copies_of(F.col("__rate"), "doc_id").alias("copies"),
    )


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], keep: str,
                  max_rate: float = 1.0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with each row as often as its rate says; all columns stay.

    The total is the one at which the domain ``keep`` keeps its size, so that with a ``max_rate`` of one
    its documents stay once and over-represented domains are thinned out.
    """
    domains = sorted(targets)
    model = fit_domains(docs, labelled, domains, rows)
    # Only posteriors are written, for the steps; for the result they are worked out once more, which
    # costs less than to write and read all texts.
    marked = written(with_posteriors(docs.select("text"), model).drop("text"))
    residuals = solve(marked, [targets[d] for d in domains], max_rate, domains.index(keep))
    rated = with_rates(with_posteriors(docs, model), residuals, len(domains), max_rate)
    copies = copies_of(F.col("__rate"), "doc_id").cast("int")
    repeated = rated.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select(*docs.columns)


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` from the labels: ``low`` quality, ``toxic``, or ``clean``."""
    domain = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(
        F.col("quality") == 1, "clean"
    )
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")
