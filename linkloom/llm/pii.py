"""Personal data: fixed formats, and looser candidates judged by gradient-boosted trees.

Generators with high recall propose overlapping spans: anything around an at-sign or its spellings, and
runs of digits with separators, each as every kind it could be.  Boosted trees judge a candidate by its
format and by the words around it.  They learn from the corpus: spans of the fixed formats are positive,
also when rewritten as people rewrite them (no plus sign, other separators, a spelt at-sign); candidates
that break a format's rule (check digit, octets, digit count) are negative.  On a part kept apart, scores
are calibrated and each kind's threshold is set for precision.  What passes is added to the fixed spans.
"""

from __future__ import annotations

import re
from collections import deque
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import Intervals, values, written

KINDS = ("email", "ip", "card", "phone")
#: Candidates to learn from: the bound of what the driver collects (under 500 bytes each).
SAMPLE_ROWS = 8000
PRECISION, CONTEXT = 0.98, 24
#: Code points of a candidate at most, and candidates that are scored at once.
MOST_LENGTH, PIECE = 160, 4096

# The formats (fixed values), written so that each takes one pass on any text.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Candidates: bounded patterns, so that no run is scanned twice in full.
_LOOSE_AT = re.compile(
    r"[^\s@<>(),;\"']{1,64} ?(?:@|[\[(] ?at ?[\])]) ?[^\s@<>(),;\"']{1,64}(?: (?:dot|\.) [A-Za-z]{2,12})?",
    re.IGNORECASE,
)
# Runs of digit groups are found whole, in one pass, and cut between groups afterwards.
_NUMBER_RUN = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9]++(?:[ ().,:/-]{1,3}+[0-9]++)*+")
_GROUP = re.compile(r"[+(]{0,2}([0-9]++)")
LEAST_DIGITS, MOST_DIGITS = 7, 19


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octets_fit(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def emails(text: str) -> list[tuple[int, int]]:
    """Each at-sign with a domain behind it, and the local part that runs up to it."""
    found, done = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            done = m.end()
    return found


def formats(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed formats, by kind and start."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if octets_fit(m[0].split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_only_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def ranges_of(text: str, start: int, end: int):
    """(start, end, digits) of the ranges of consecutive groups with 7 to 19 digits in a run of numbers.

    Neighbours may be one thing or several.  A range has 19 groups at most, so this is linear in the run.
    """
    word = text[end : end + 1].isascii() and text[end : end + 1].isalpha()
    groups: deque[tuple[int, int, int]] = deque()

    def ranges():
        """Those that begin with the first group that is held."""
        n, a = 0, groups[0][0]
        for _, b, digits in groups:
            n += digits
            if n > MOST_DIGITS:
                break
            if n >= LEAST_DIGITS:
                yield a, b, n

    for m in _GROUP.finditer(text, start, end):
        if word and m.end() == end:
            break  # the last group goes on as a word
        groups.append((m.start(), m.end(), m.end() - m.start(1)))
        if len(groups) == MOST_DIGITS:
            yield from ranges()
            groups.popleft()
    while groups:
        yield from ranges()
        groups.popleft()


def candidates(text: str):
    """(kind, start, end) of what could be personal data, one by one; spans overlap, and kinds share them.

    Longer spans than ``MOST_LENGTH`` are none of these.
    """
    if "@" in text or "(at" in (low := text.lower()) or "[at" in low or "( at" in low:
        for m in _LOOSE_AT.finditer(text):
            if m.end() - m.start() <= MOST_LENGTH:
                yield "email", *m.span()
    if not _DIGIT.search(text):
        return
    # Dotted quads are short of seven digits at times.
    quads = {m.span() for m in _IP.finditer(text) if m.end() - m.start() < 40}
    yield from (("ip", a, b) for a, b in sorted(quads))
    for m in _NUMBER_RUN.finditer(text):
        for a, b, n in ranges_of(text, *m.span()):
            if b - a > MOST_LENGTH:
                continue
            if text.count(".", a, b) >= 3 and (a, b) not in quads:
                yield "ip", a, b
            if 12 <= n <= 19:
                yield "card", a, b
            if 7 <= n <= 15:
                yield "phone", a, b


# Words that tell what stands next to them (fixed values).
_CUES = {
    "email": ("mail", "contact", "write", "@"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("tel", "phone", "call", "fax", "mobil"),
    "other": ("version", "isbn", "date", "page", "no.", "#"),
}
FEATURES = 27


def features(kind: str, before: str, match: str, after: str) -> list[float]:
    """Format of the span, and its surroundings; the text far away has no say."""
    digits = _only_digits(match)
    groups = re.findall("[0-9]+", match)
    lengths = [len(g) for g in groups] or [0]
    low = before.lower()
    domain = match.rpartition("@")[2]
    return [
        KINDS.index(kind), len(match), len(digits), sum(c.isalpha() for c in match),
        match.count("."), match.count("-"), match.count(" "), match.count("@"),
        match.count("(") + match.count("["), match.count(",") + match.count(":") + match.count("/"),
        match.startswith("+"), len(groups), max(lengths), min(lengths), lengths[-1],
        luhn(digits) if digits else 0, len(groups) == 4 and octets_fit(groups),
        len(set(digits)) / max(1, len(digits)), domain.count(".") if "@" in match else -1,
        len(domain.rpartition(".")[2]) if "." in domain else 0,
        "at" in match.lower() and "@" not in match,
        *(any(cue in low for cue in cues) for cues in _CUES.values()),
        after[:1].isspace() or not after,
    ]


def follows_rule(kind: str, match: str) -> bool:
    """Whether the span would hold what the kind demands, whatever its separators."""
    digits, groups = _only_digits(match), re.findall("[0-9]+", match)
    if kind == "email":
        return bool(re.search(r"[\w.%+-]+ ?(@|[\[(] ?at ?[\])]) ?[\w-]+( ?(\.|dot) ?[\w-]+)+", match, re.I))
    if kind == "ip":
        return len(groups) == 4 and octets_fit(groups)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    # Without a plus sign or an area code in brackets, digits with signs are anything.
    return 8 <= len(digits) <= 15 and max(map(len, groups)) <= 5 and ("+" in match or "(" in match)


def rewritten(kind: str, match: str) -> list[str]:
    """How people write the same thing otherwise."""
    if kind == "email":
        return [match.replace("@", " (at) "), match.replace("@", " [at] ")]
    if kind == "card":
        d = _only_digits(match)
        return [sep.join(d[i : i + 4] for i in range(0, len(d), 4)) for sep in ("-", " ", ".")]
    if kind == "phone":
        bare = match.lstrip("+")
        return [bare, match.replace("(", "").replace(")", ""), bare.replace(" ", "-"), bare.replace("-", ".")]
    return [match]


def broken(kind: str, match: str) -> list[str]:
    """Near misses: a check digit, an octet, a domain or a number of digits is wrong."""
    if kind == "email":
        return [match.replace(".", ""), match.partition("@")[0] + "@x", match.replace("@", " at @ ")]
    if kind == "ip":
        first, dot, rest = match.partition(".")
        return ["7" + first.rjust(3, "0") + dot + rest, rest, match + ".1"]
    if kind == "card":
        return [match[:-1] + str((int(match[-1]) + k) % 10) for k in (1, 5)] + [match[:-3]]
    return [match[1:6] + match[-3:], match + "-" + "7315" * 2, _only_digits(match) + "00"]


class Trees:
    """Boosted regression trees on binned features, for the logistic loss."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.edges, self.trees, self.start = [], [], 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = np.linspace(0, 1, self.bins)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], cuts)) for j in range(x.shape[1])]
        binned = self._binned(x)
        n, width = binned.shape
        slots = binned + np.arange(width) * self.bins
        share = y.mean()
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, curve = p - y, p * (1 - p)
            leaf = np.zeros(n, np.int64)
            splits = []
            for level in range(self.depth):
                nodes = 1 << level
                flat = (slots + (leaf * width * self.bins)[:, None]).ravel()
                shape = (nodes, width, self.bins)
                g, h = (
                    np.bincount(flat, np.repeat(v, width), nodes * width * self.bins)
                    .reshape(shape).cumsum(axis=2)
                    for v in (gradient, curve)
                )
                gain_of = lambda a, b: a * a / (b + 1.0)
                gain = gain_of(g, h) + gain_of(g[:, :, -1:] - g, h[:, :, -1:] - h)
                best = gain.reshape(nodes, -1).argmax(axis=1)
                feature, bound = best // self.bins, best % self.bins
                splits.append((feature, bound))
                leaf = 2 * leaf + (binned[np.arange(n), feature[leaf]] > bound[leaf])
            leaves = 1 << self.depth
            value = -self.rate * np.bincount(leaf, gradient, leaves) / (
                np.bincount(leaf, curve, leaves) + 1.0
            )
            self.trees.append((splits, value))
            score += value[leaf]
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        for splits, value in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for feature, bound in splits:
                leaf = 2 * leaf + (binned[rows, feature[leaf]] > bound[leaf])
            out += value[leaf]
        return out


class Judge:
    """Trees, a calibration of their scores, and a threshold for each kind (1.1: never)."""

    def __init__(self, trees: Trees | None = None):
        self.trees, self.slope, self.shift = trees, 1.0, 0.0
        self.thresholds = dict.fromkeys(KINDS, 1.1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.scores(x) + self.shift, -30, 30)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, precision: float) -> None:
        """Platt scaling by Newton steps, then the least threshold that keeps the precision."""
        s = self.trees.scores(x)
        design = np.stack([s, np.ones_like(s)], axis=1)
        w = start = np.array([1.0, 0.0])
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(30):  # with a pull towards the trees' own scale, as the classes may be separable
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            curve = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
            w = w - 0.7 * np.linalg.solve(curve, design.T @ (p - target) + (w - start))
        self.slope, self.shift = w
        p = self.probabilities(x)
        for k, kind in enumerate(KINDS):
            own = x[:, 0] == k
            order = np.argsort(-p[own], kind="stable")
            ranked, truth = p[own][order], y[own][order]
            right = truth.cumsum() / np.arange(1, len(truth) + 1)
            last = np.append(ranked[1:] != ranked[:-1], True)[: len(ranked)]
            fine = np.flatnonzero(last & (right >= precision) & (ranked >= 0.5))
            if len(fine):
                self.thresholds[kind] = float(ranked[fine[-1]])


def learn(rows: list[tuple[str, str, str, str, bool]], precision: float = PRECISION) -> Judge:
    """From (kind, before, match, after, has the format); without both classes, adds nothing."""
    x, y, apart = [], [], []
    for kind, before, match, after, fixed in rows:
        held = xxhash.xxh64_intdigest(match.encode()) % 3 == 0
        right = [match, *rewritten(kind, match)] if fixed else []
        for form in [*right, *(broken(kind, match) if fixed else [match])]:
            x.append(features(kind, before, form, after))
            y.append(form in right or follows_rule(kind, form))
            apart.append(held)
    x, y, apart = np.array(x, float).reshape(-1, FEATURES), np.array(y, float), np.array(apart, bool)
    if any(len(set(y[part])) < 2 for part in (apart, ~apart)):
        return Judge()
    judge = Judge(Trees().fit(x[~apart], y[~apart]))
    judge.calibrate(x[apart], y[apart], precision)
    return judge


_EXAMPLE = "rank long, kind string, before string, match string, after string, fixed boolean"


def _examples(most: int):
    """Candidates to learn from, with and without a fixed format: of each the ``most`` of least hash.

    The hash is of what is learnt from, so that a task's choice holds all that the table's needs.
    """

    def run(batches):
        held: dict[bool, dict[tuple, int]] = {True: {}, False: {}}

        def add(text: str, fixed: bool, kind: str, a: int, b: int) -> None:
            example = (kind, text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT])
            own = held[fixed]
            if example not in own:
                own[example] = xxhash.xxh64_intdigest("\n".join(example).encode()) >> 1
                if len(own) >= 2 * most:
                    held[fixed] = dict(sorted(own.items(), key=lambda e: (e[1], e[0]))[:most])

        for batch in batches:
            for text in values(batch, "text"):
                text = text or ""
                own = [s for s in formats(text) if s[2] - s[1] <= MOST_LENGTH]
                for span in own:
                    add(text, True, *span)
                fixed = set(own)
                for span in candidates(text):
                    if span not in fixed:
                        add(text, False, *span)
        for fixed, own in held.items():
            for at in range(0, len(own), 4096):
                part = list(own.items())[at : at + 4096]
                columns = [[rank for _, rank in part], *zip(*(e for e, _ in part)), [fixed] * len(part)]
                types = [pa.int64(), *[pa.string()] * 4, pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)],
                    ["rank", "kind", "before", "match", "after", "fixed"],
                )

    return run


def _likely(judge: Judge, text: str, fixed: set) -> list[np.ndarray]:
    """Place in ``KINDS``, start, end and probability of the candidates over their threshold.

    Candidates are scored in pieces, so that what is held of a long run of numbers is what passes.
    """
    limits, found = np.array([judge.thresholds[k] for k in KINDS]), []
    proposed = (c for c in candidates(text) if c not in fixed)
    while piece := list(islice(proposed, PIECE)):
        x = [features(k, text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT]) for k, a, b in piece]
        p = judge.probabilities(np.array(x, float))
        kind = np.array([KINDS.index(k) for k, _, _ in piece], np.int8)
        passed = np.flatnonzero(p >= limits[kind])
        spans = np.array([c[1:] for c in piece], np.int64)[passed]
        found.append((kind[passed], spans[:, 0], spans[:, 1], p[passed]))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0)] * 4


def added_spans(judge: Judge, text: str, base: list[tuple]) -> list[tuple]:
    """The candidates over their kind's threshold that touch no span so far, the surest first."""
    if judge.trees is None:
        return []
    kind, start, end, p = _likely(judge, text, set(base))
    taken, added = Intervals((a, b) for _, a, b in base), []
    for i in np.lexsort((kind, end, start, -p)).tolist():
        a, b = int(start[i]), int(end[i])
        if not taken.touches(a, b):
            taken.add(a, b)
            added.append((KINDS[int(kind[i])], a, b))
    return added


def _report(judge: Judge):
    def run(batches):
        place = {k: i for i, k in enumerate(KINDS)}
        order = lambda s: (place[s[0]], s[1], s[2])
        line = lambda own: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(own, key=order))
        for batch in batches:
            out = []
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                spans = formats(text or "")
                added = added_spans(judge, text or "", spans)
                kinds = [s[0] for s in spans]
                out.append(
                    (doc_id, *(kinds.count(k) for k in KINDS), sha256(line(spans).encode()).hexdigest(),
                     line(spans + added), len(added))
                )
            columns = zip(*out) if out else [()] * 8
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names
            )

    return run


def find_pii(docs: DataFrame, rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``, a row per row of ``docs``.

    Counts and ``base_sha256`` are of the fixed formats, ``spans`` holds all spans as ``kind:start:end``
    in code points, by kind and start.  Null and empty texts have none.  ``rows`` bounds the sample of
    candidates to learn from, picked by hash over the whole table, half with the format and half
    without; where a class is missing, nothing is added.  Candidates of over 160 code points are none.
    A text of any length is scored in pieces.  Repeated rows are found alike; an empty table
    gives no rows.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    start = docs.select(F.col("doc_id").cast("long"), "text")
    # Each task sends so many at most, whatever its texts hold.
    each = written(start.select("text").mapInArrow(_examples(rows // 2), _EXAMPLE)).distinct()
    order = ["rank", "kind", "before", "match", "after"]
    halves = [
        each.where(F.col("fixed") == want).orderBy(*order).limit(rows // 2).collect()
        for want in (True, False)
    ]
    sample = [(r.kind, r.before, r.match, r.after, r.fixed) for half in halves for r in half]
    judge = learn(sample, precision)
    return start.mapInArrow(
        _report(judge),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
        " spans string, n_added long",
    )


def redact(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping ones are united."""
    at = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, done = [], 0
    for a, b, kind in at:
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])
