"""Quality classifier: a generalised additive model with pairwise interactions.

A score is the logistic of an intercept plus one table entry per feature plus one per pair of features.
The tables are learned by cyclic boosting: round after round every feature in turn gets a small
step of a tree of three leaves, grown on the rest the others leave; then the pairs whose interaction
explains most get theirs, from trees of four quadrants. Scoring finds each feature's bin and adds.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Sent, held_out, map_batches, scratch, stage, texts

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
BLANKS = b" \t\n\x0b\x0c\r"
STOPS = b".,;:?'\"()-"
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in STOPS)

FEATURES = [
    "log_bytes", "log_words", "bytes_per_word", "distinct_words", "top_word", "repeats", "short_words",
    "capital_words", "upper", "digits", "stops", "marks", "bars", "exclamations", "other_bytes",
    "log_lines", "repeated_lines", "words_per_line", "ends_in_stop", "odd_words",
]


def features(text: bytes) -> list[float]:
    """FEATURES of a whole text; an empty one has zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    words, lines = text.split(), text.split(b"\n")
    w, count = max(1, len(words)), Counter(words)
    left = n - len(text.translate(None, BLANKS)) or 0
    solid = max(1, n - left)
    upper, digits = n - len(text.translate(None, UPPER)), n - len(text.translate(None, DIGITS))
    lower = n - len(text.translate(None, LOWER))
    stops, marks = n - len(text.translate(None, STOPS)), n - len(text.translate(None, MARKS))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    short = sum(c for x, c in count.items() if len(x) <= 3)
    capital = sum(c for x, c in count.items() if len(x) > 1 and x.isupper())
    odd = sum(c for x, c in count.items() if not x.strip(STOPS).isalpha() and x.isascii())
    return [
        math.log1p(n), math.log1p(len(words)), solid / w, len(count) / w,
        max(count.values(), default=0) / w, repeats / w, short / w, capital / w,
        upper / solid, digits / solid, stops / solid, marks / solid,
        text.count(b"|") / w, text.count(b"!") / w, (solid - upper - lower - digits - stops - marks) / solid,
        math.log1p(len(lines)), 1 - len({*lines}) / len(lines), math.log1p(len(words) / len(lines)),
        float(text.rstrip()[-1:] in (b".", b"!", b"?")), odd / w,
    ]


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row; null texts count as empty."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([features(t) for t in texts(batch.column(1))], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "features"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, make, "doc_id long, features array<double>")


def _line_tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """Values of the best three-leaf tree over ordered bins with gradient and curvature sums."""

    def best(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        gain = cg[:-1] ** 2 / (ch[:-1] + penalty) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + penalty)
        i = int(gain.argmax())
        return float(gain[i] - cg[-1] ** 2 / (ch[-1] + penalty)), a + i + 1

    _, first = best(0, len(g))
    cuts = {0, first, len(g)}
    (left_gain, left), (right_gain, right) = best(0, first), best(first, len(g))
    cuts.add(left if left_gain >= right_gain else right)
    out = np.zeros(len(g))
    for a, b in itertools.pairwise(sorted(cuts)):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts each of two features once."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a = (cg[:-1, :-1], ch[:-1, :-1])
    b = (cg[:-1, -1:] - a[0], ch[:-1, -1:] - a[1])
    c = (cg[-1:, :-1] - a[0], ch[-1:, :-1] - a[1])
    d = (cg[-1, -1] - a[0] - b[0] - c[0], ch[-1, -1] - a[1] - b[1] - c[1])
    if not a[0].size:
        return 0.0, np.zeros(g.shape)
    gain = sum(x**2 / (np.maximum(y, 0) + penalty) for x, y in (a, b, c, d))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros(g.shape)
    for rows, columns, (x, y) in (
        (slice(None, i + 1), slice(None, j + 1), a), (slice(None, i + 1), slice(j + 1, None), b),
        (slice(i + 1, None), slice(None, j + 1), c), (slice(i + 1, None), slice(j + 1, None), d),
    ):
        out[rows, columns] = x[i, j] / (max(y[i, j], 0) + penalty)
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + penalty)), out


class AdditiveModel:
    """Fits and scores; features may be any numbers, labels anything from 0 to 1."""

    def __init__(self, bins: int = 48, pair_bins: int = 12, pairs: int = 8, rounds: int = 120, rate: float = 0.15, penalty: float = 2.0):
        self.bins, self.pair_bins, self.n_pairs = bins, pair_bins, pairs
        self.rounds, self.rate, self.penalty = rounds, rate, penalty

    @staticmethod
    def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Without rows the score is 1/2; with labels of one kind it stays near their mean."""
        n, k = x.shape
        mean = (y.sum() + 0.5) / (n + 1)
        self.intercept = math.log(mean / (1 - mean))
        self.cuts = [self._cuts(x[:, j], self.bins) for j in range(k)]
        self.pair_cuts = [self._cuts(x[:, j], self.pair_bins) for j in range(k)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if not n:
            return self
        at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]
        logit = np.full(n, self.intercept)

        def sums(where: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-logit))
            return np.bincount(where, y - p, size), np.bincount(where, p * (1 - p), size)

        for _ in range(self.rounds):
            for j in range(k):
                step = self.rate * _line_tree(*sums(at[j], len(self.tables[j])), self.penalty)
                self.tables[j] += step
                logit += step[at[j]]

        coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.pair_cuts)]
        shape = [len(c) + 1 for c in self.pair_cuts]

        def tree(i: int, j: int) -> tuple[float, np.ndarray]:
            g, h = sums(coarse[i] * shape[j] + coarse[j], shape[i] * shape[j])
            return _quadrants(g.reshape(shape[i], shape[j]), h.reshape(shape[i], shape[j]), self.penalty)

        ranked = sorted(itertools.combinations(range(k), 2), key=lambda p: (-tree(*p)[0], p))
        self.pairs = ranked[: self.n_pairs]
        self.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in self.pairs]
        for _ in range(self.rounds // 2):
            for table, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
                step = self.rate * tree(i, j)[1]
                table += step
                logit += step[coarse[i], coarse[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            logit += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            rows = np.searchsorted(self.pair_cuts[i], x[:, i], side="right")
            logit += table[rows, np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-logit))


def learn(featured: DataFrame, labels: DataFrame, max_rows: int = 50_000, model: AdditiveModel | None = None) -> AdditiveModel:
    """A model of labels.quality from at most `max_rows` labelled rows outside the held-out quarter.

    The rows are a hash sample of all labelled ones. Null labels and null doc_ids are left out; several labels
    of one document count as their mean.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    known = known.where(~held_out(F.col("doc_id")))
    share = min(1.0, 0.95 * max_rows / max(1, known.count()))
    chance = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    known = known.where(chance < share)
    rows = featured.join(known, "doc_id").select("features", "y").limit(max_rows).toPandas()
    x = np.array(rows["features"].tolist()).reshape(len(rows), len(FEATURES))
    y = rows["y"].to_numpy(float)
    order = np.lexsort((y, *x.T))  # so that the sums don't depend on the order of arrival
    return (model or AdditiveModel()).fit(x[order], y[order])


class Quality:
    """Scores `docs` (doc_id, text) as `labels` (doc_id, quality) mark them.

    Only the text enters a score; empty and null texts have a score too, learned like any other.
    Equal texts have equal scores, so repeated rows and rows without a doc_id do too. Labels that repeat or contradict
    each other count as their mean. Texts of any length are read whole; other columns play no part. Empty tables give no
    rows, or scores of 1/2 if there are no labels. Texts are read once: their features, about 160 bytes a row, are written and serve both
    learning and scoring.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, max_rows: int = 50_000):
        self.featured = stage(with_features(docs), scratch(docs.sparkSession, "features"))
        self.model = learn(self.featured, labels, max_rows)

    def scores(self) -> DataFrame:
        """One row per document: doc_id, score."""
        sent = Sent(self.featured.sparkSession, self.model)

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.score(x))], ["doc_id", "score"])

        return map_batches(self.featured, make, "doc_id long, score double")
