"""Quality by a generalised additive model with pairwise interactions.

Features of a text are cut into bins.  Cyclic boosting visits the features in turn and
adds a shallow tree over its bins to each one's lookup table; then pairs of features get
tables in the same way.  A score is the sum of the looked-up values, taken for a whole
batch of texts at once.

The model is fitted on at most ``SAMPLE`` labelled training rows, those of smallest hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import small_batches
from ebbline.llm.toxicity import labelled

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 150, 80, 0.1, 4
FEATURES = (
    "words", "bytes_per_word", "distinct_words", "same_as_before", "upper", "digits", "symbols", "commonest_symbol",
    "bars", "exclamations", "sentence_marks", "lines", "longest_word", "not_ascii", "symbol_words", "worst_fifth",
)


def _kinds() -> np.ndarray:
    """Kind of each byte: upper-case letter, digit, symbol, bar, exclamation mark, mark, line, other."""
    kind = np.full(256, 7)
    kind[65:91], kind[48:58], kind[10] = 0, 1, 6
    kind[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
    kind[[ord(c) for c in ".,;:?'\"()-"]] = 5
    kind[ord("|")], kind[ord("!")] = 3, 4
    return kind


_KIND = _kinds()


def _symbols(counts: np.ndarray) -> np.ndarray:
    return np.bincount(_KIND, weights=counts, minlength=8)


def features(text: str | None) -> list[float]:
    """The features of a whole text; those of an empty or null one are all 0."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    kinds, n, size = _symbols(counts), len(words), len(data)
    same = sum(map(bytes.__eq__, words, words[1:]))
    fifths = [_symbols(np.bincount(part, minlength=256)) / max(1, len(part)) for part in np.array_split(raw, 5)]
    odd = [k[0] + k[2] + k[3] + k[4] for k in fifths]
    dirty = sum(_KIND[w[-1]] in (2, 4) for w in words)
    return [
        np.log1p(n), size / n, len(set(words)) / n, same / n, kinds[0] / size, kinds[1] / size, kinds[2] / size,
        counts[_KIND == 2].max() / size, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n,
        max(map(len, words)), counts[128:].sum() / size, dirty / n, max(odd),
    ]


def _tree(gain: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values of a shallow tree over ordered bins: the best cuts, one after another."""
    cuts = [0, len(gain)]
    total = lambda a, b: gain[a:b].sum() ** 2 / (weight[a:b].sum() + 1.0)
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:], strict=False):
            g, h = np.cumsum(gain[a:b])[:-1], np.cumsum(weight[a:b])[:-1]
            if len(g):
                won = g**2 / (h + 1) + (gain[a:b].sum() - g) ** 2 / (weight[a:b].sum() - h + 1) - total(a, b)
                if won.max() > best:
                    best, at = won.max(), a + 1 + int(won.argmax())
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(gain))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = gain[a:b].sum() / (weight[a:b].sum() + 1.0)
    return out


def _table(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Values of a tree over two features: cuts of one, and inside each part cuts of the other."""
    best, table = -1.0, np.zeros(gain.shape)
    for axis in (0, 1):
        g, h = (gain, weight) if axis == 0 else (gain.T, weight.T)
        outer = _tree(g.sum(axis=1), h.sum(axis=1), 2)
        split = int(np.argmax(outer != outer[0])) or len(outer)
        out = np.zeros(g.shape)
        for part in (slice(0, split), slice(split, None)):
            out[part] = _tree(g[part].sum(axis=0), h[part].sum(axis=0), 2) if len(g[part]) else 0
        won = float((out * g).sum())
        if won > best:
            best, table = won, out if axis == 0 else out.T
    return table


class Model:
    """Bin edges, a table for each feature and for each chosen pair, and an intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        """x: rows of features, y: their labels (0 or 1); without rows the score is 0.5."""
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        self.pair_edges = coarse
        self.start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if len(y) == 0 or y.min() == y.max():
            return
        bins = self.bins(x, self.edges)
        z = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-z))
                step = RATE * _tree(*self._sums(bins[f], len(table), y - p, p * (1 - p)))
                table += step
                z += step[bins[f]]
        few = self.bins(x, coarse)
        sizes = [len(e) + 1 for e in coarse]
        p = 1 / (1 + np.exp(-z))
        won = []
        for a in range(len(sizes)):
            for b in range(a):
                g, h = self._sums(few[a] * sizes[b] + few[b], sizes[a] * sizes[b], y - p, p * (1 - p))
                won.append((float((g**2 / (h + 1)).sum()), a, b))
        self.pairs = [(a, b) for _, a, b in sorted(won, reverse=True)[:PAIRS]]
        self.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                p = 1 / (1 + np.exp(-z))
                g, h = self._sums(few[a] * sizes[b] + few[b], table.size, y - p, p * (1 - p))
                step = RATE * _table(g.reshape(table.shape), h.reshape(table.shape))
                table += step
                z += step[few[a], few[b]]

    @staticmethod
    def _sums(bins: np.ndarray, n: int, gain: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(bins, weights=gain, minlength=n), np.bincount(bins, weights=weight, minlength=n)

    @staticmethod
    def bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for table, b in zip(self.tables, self.bins(x, self.edges), strict=True):
            z += table[b]
        few = self.bins(x, self.pair_edges)
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[few[a], few[b]]
        return 1 / (1 + np.exp(-z))


def _rows(texts: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pa.Array) -> pa.Array:
    return pa.array(_rows(texts).tolist(), type=pa.list_(pa.float64()))


def scorer(model: Model):
    """A column function from text to score."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_rows(texts)), type=pa.float64())

    return score


def fit(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of the labels; `training` says of a labels row whether it may be learnt from."""
    small_batches(docs.sparkSession)
    some = labelled(docs, labels, label, training, sample).select("y", _features("text").alias("x")).toPandas()
    x = np.stack(some["x"].to_numpy()) if len(some) else np.zeros((0, len(FEATURES)))
    return Model(x, some["y"].to_numpy(dtype=float))


def training_rows(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the doc_id's text modulo 4 isn't 2."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of documents (doc_id, text).

    Null and empty texts are scored by features of 0.  Labels other than 0 and 1 are none;
    with labels of one kind or none at all the score is their smoothed share.
    """
    model = fit(docs, labels, training_rows(F.col("doc_id")))
    held = F.coalesce(~training_rows(F.col("doc_id")), F.lit(False))
    scored = docs.select("doc_id", held.alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
