"""Document quality by a byte-level convolutional network, in numpy.

The UTF-8 bytes of a text are embedded and cut into chunks that overlap by a window, so that all chunks
together see every window of the whole document.  Windows are eight bytes long and start at multiples of
four: every byte is seen, but not at every offset.  Filters of a window's length are learned; each
filter's largest response over all chunks is taken, and a logistic layer combines these into one
probability.  Training touches, for each document and filter, the window of the largest response only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import values

#: Labelled rows to learn from, of at most so many bytes each: the bound of what the driver collects.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 8000, 1 << 15
FOLDS, THRESHOLD = 5, 0.3
STEP, FILTERS, WIDTH = 4, 24, 4  # bytes between windows of two steps; embedding width
CHUNK = 1 << 14
EPOCHS, BATCH, LEAST_STEPS = 8, 32, 600


@dataclass
class Network:
    embed: np.ndarray  # 256 x WIDTH
    head: np.ndarray  # STEP * WIDTH x FILTERS, first half of the window
    tail: np.ndarray  # the same for the second half
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def initial(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        half = STEP * WIDTH
        return cls(
            normal(256, WIDTH, scale=0.5), normal(half, FILTERS, scale=0.3),
            normal(half, FILTERS, scale=0.3), np.zeros(FILTERS, np.float32),
            normal(FILTERS, scale=0.3), 0.0,
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.head, self.tail, self.bias, self.weights]


def as_steps(text: str | None) -> np.ndarray:
    """The bytes as rows of STEP, padded with zeros, with one row more than windows."""
    raw = (text or "").encode()
    rows = max(1, -(-len(raw) // STEP)) + 1
    padded = np.zeros(rows * STEP, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    return padded.reshape(rows, STEP)


def strongest(net: Network, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest response over the document, and the window it comes from."""
    both = np.concatenate([net.head, net.tail], axis=1)
    top, place = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS, np.int64)
    rows = CHUNK // STEP
    for at in range(0, len(steps) - 1, rows):
        part = steps[at : at + rows + 1]  # one step of overlap: no window is missed
        found = net.embed[part].reshape(len(part), -1) @ both
        response = found[:-1, :FILTERS] + found[1:, FILTERS:]
        where = response.argmax(axis=0)
        value = response[where, np.arange(FILTERS)]
        better = value > top
        top[better], place[better] = value[better], where[better] + at
    return top, place


def probability(net: Network, steps: np.ndarray) -> float:
    both = np.concatenate([net.head, net.tail], axis=1)
    top = np.full(FILTERS, -np.inf, np.float32)
    rows = CHUNK // STEP
    for at in range(0, len(steps) - 1, rows):
        part = steps[at : at + rows + 1]
        found = net.embed[part].reshape(len(part), -1) @ both
        top = np.maximum(top, (found[:-1, :FILTERS] + found[1:, FILTERS:]).max(axis=0))
    pooled = np.tanh(np.maximum(top + net.bias, 0))
    return float(1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.offset, -30, 30))))


def fit(texts: list[str | None], labels: list[int], seed: int = 1) -> Network:
    """Adam on the cross-entropy; both classes weigh the same.

    Eight passes, or more where few documents would give few steps.
    """
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    net = Network.initial(seed)
    y = np.array(labels, np.float32)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    docs = [as_steps(t) for t in texts]
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(a) for a in net.arrays()] + [0.0]
    second = [np.zeros_like(a) for a in net.arrays()] + [0.0]
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        for at in range(0, len(order), BATCH):
            grads = [np.zeros_like(a) for a in net.arrays()] + [0.0]
            batch = order[at : at + BATCH]
            for i in batch:
                top, place = strongest(net, docs[i])
                active = top + net.bias > 0
                pooled = np.tanh(np.maximum(top + net.bias, 0))
                p = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.offset, -30, 30)))
                g = (p - y[i]) * weight[i] / len(batch)
                grads[4] += g * pooled
                grads[5] += g
                back = np.where(active, g * net.weights * (1 - pooled**2), 0).astype(np.float32)
                grads[3] += back
                for half, place_of in ((1, place), (2, place + 1)):
                    octets = docs[i][place_of]  # FILTERS x STEP
                    vectors = net.embed[octets].reshape(FILTERS, -1)
                    grads[half] += vectors.T * back
                    filters = (net.head, net.tail)[half - 1]
                    np.add.at(
                        grads[0], octets.ravel(), (filters.T * back[:, None]).reshape(-1, WIDTH)
                    )
            t += 1
            arrays = [*net.arrays(), net.offset]
            for k, (a, gr) in enumerate(zip(arrays, grads)):
                gr = gr + 1e-4 * a
                first[k] = 0.9 * first[k] + 0.1 * gr
                second[k] = 0.99 * second[k] + 0.01 * gr * gr
                step = rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-6)
                if k < 5:
                    a -= step.astype(np.float32)
                else:
                    net.offset = float(a - step)
    return net


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo five; null counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple]:
    """Up to ``rows`` pairs (text, quality) outside the held-out fold, the same ones on every run.

    Ids with several labels take the rounded mean; texts over ``SAMPLE_TEXT_BYTES`` are passed over.
    """
    usable = labels.where((fold(F.col("doc_id")) != 0) & F.col("quality").isNotNull())
    order = F.xxhash64("doc_id")
    chosen = (
        usable.groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.round(F.avg("quality")).cast("int").alias("quality"), F.min(order).alias("rank"))
        .orderBy("rank", "id").limit(rows)
    )
    short = docs.where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_TEXT_BYTES)
    found = short.select(F.col("doc_id").cast("long").alias("id"), "text").join(
        F.broadcast(chosen), "id"  # rows * 20 bytes
    )
    best = found.groupBy("id").agg(F.min("text").alias("text"), F.first("quality"), F.first("rank"))
    return [(r[1], r[2]) for r in sorted(best.collect(), key=lambda r: (r[3], r[0]))]


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """A network fitted on the sample; without two classes it is constant (the mean, or a half)."""
    sample = labelled_sample(docs, labels, rows)
    classes = {q for _, q in sample}
    if len(classes) < 2:
        net = Network.initial(0)
        net.weights[:] = 0
        net.offset = {frozenset(): 0.0, frozenset({1}): 30.0}.get(frozenset(classes), -30.0)
        return net
    return fit([t for t, _ in sample], [q for _, q in sample])


def _scores(net: Network):
    def run(batches):
        for batch in batches:
            scores = [probability(net, as_steps(t)) for t in values(batch, "text")]
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores, pa.float64())], [*batch.schema.names, "__score"]
            )

    return run


def with_score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``__score``: the probability of quality 1, from the whole text alone."""
    schema = docs.select("*", F.lit(0.0).alias("__score")).schema
    return docs.mapInArrow(_scores(net), schema)


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Null and empty texts are scored as texts of zero bytes; repeated rows get the same score.  Without
    labels every score is a half; with one class only, 1 or 0.  An empty table gives no rows.  Labels,
    language, source and id are no inputs of the score.
    """
    net = train(docs, labels, rows)
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net)
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the documents that the network rejects; all columns stay."""
    scored = with_score(docs, train(docs, labels, rows))
    return scored.where(F.col("__score") >= THRESHOLD).select(*docs.columns)
