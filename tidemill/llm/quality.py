"""Operator 7. Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text (shares, ratios and lengths, nothing learned from the
words themselves) is cut into bins. Boosting goes round the features in turn:
a shallow tree over one feature's bins is fitted to the residuals and added,
damped, to that feature's lookup table. Then the pairs whose joint bins
explain most of what is left get two-dimensional tables in the same way. A
score is the sigmoid of a sum of table look-ups, vectorised over a batch.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``);
every text is scored whole.

Defined cases: null and empty texts have all features 0 and are scored like
any other; rows with a null label are not learned from; several labels of one
id count once, by their largest; without labelled rows every score is 0.5;
labels of one class only give that class's smoothed share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import held_out, open_table

FEATURES = (
    "log_chars",
    "log_words",
    "word_length",
    "letters",
    "upper",
    "digits",
    "symbols",
    "exclaims",
    "non_ascii",
    "distinct_words",
    "top_word",
    "repeated_lines",
    "log_words_a_line",
    "short_words",
    "compressed",
    "lines_ended",
)
SAMPLE_ROWS = 20_000  # labelled rows the model is fitted on, about
BINS, ROUNDS, RATE, RIDGE = 32, 200, 0.1, 5.0
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 8, 60
GOOD = 0.7

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CLASS = np.zeros((5, 256))
for _row, _set in enumerate(
    (b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?")
):
    _CLASS[_row, list(_set)] = 1


def features(text: str | None) -> list[float]:
    """The numbers of ``FEATURES`` for one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, upper, digits, symbols, exclaims = _CLASS @ counts
    wide = int(counts[128:].sum())
    words = _WORD.findall(text)
    n, size = len(words), len(data)
    lines = [x for x in text.split("\n") if x.strip()]
    often = Counter(words)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        sum(map(len, words)) / n if n else 0.0,
        (letters + wide) / size,
        upper / max(1.0, letters),
        digits / size,
        symbols / size,
        exclaims / size,
        wide / size,
        len(often) / n if n else 0.0,
        max(often.values()) / n if n else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        float(np.log1p(n / len(lines))) if lines else 0.0,
        sum(1 for w in words if len(w) <= 3) / n if n else 0.0,
        len(zlib.compress(data, 1)) / size,
        sum(1 for x in lines if x.rstrip()[-1] in ".!?") / len(lines) if lines else 0.0,
    ]


def matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def _leaf_values(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """A shallow tree over ordered bins: greedy cuts, each leaf G / (H + RIDGE)."""
    cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + RIDGE)
    edges = [0, len(g)]
    for _ in range(splits):
        found = []
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = worth(a, cut) + worth(cut, b) - worth(a, b)
                k = int(np.argmax(gain))
                found.append((float(gain[k]), int(cut[k])))
        if not found or max(found)[0] <= 1e-9:
            break
        edges = sorted([*edges, max(found)[1]])
    out = np.empty(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best cut of each axis of a pair's bins: four leaves and what they gain."""
    cg, ch = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]
    parts = []
    for a0, a1, b0, b1 in ((0, i, 0, j), (0, i, j, m), (i, n, 0, j), (i, n, j, m)):
        box = lambda c: c[a1, b1] - c[a0, b1] - c[a1, b0] + c[a0, b0]  # noqa: B023, E731
        parts.append((box(cg), box(ch)))
    gain = sum(pg**2 / (ph + RIDGE) for pg, ph in parts)
    k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [float(pg[k] / (ph[k] + RIDGE)) for pg, ph in parts]
    out = np.empty((n, m))
    a, b = k[0] + 1, k[1] + 1
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = v
    return out, float(gain[k])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Gam:
    """Lookup tables by feature and by pair of features."""

    def __init__(self) -> None:
        self.base, self.cuts, self.tables, self.pair_cuts, self.pairs = 0.0, [], [], [], {}

    def fit(self, x: np.ndarray, y: np.ndarray) -> Gam:
        if not len(y):
            return self
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        cut = lambda v, n: np.unique(np.quantile(v, np.linspace(0, 1, n + 1)[1:-1]))
        self.cuts = [cut(x[:, f], BINS) for f in range(x.shape[1])]
        self.pair_cuts = [cut(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        if y.min() == y.max():
            return self
        bins = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)]
        score = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                if len(self.tables[f]) < 2:
                    continue
                p = _sigmoid(score)
                step = RATE * _leaf_values(np.bincount(b, y - p, len(self.tables[f])), np.bincount(b, p * (1 - p), len(self.tables[f])))
                self.tables[f] += step
                score += step[b]
        coarse = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.pair_cuts)]
        shape = lambda f, g: (len(self.pair_cuts[f]) + 1, len(self.pair_cuts[g]) + 1)

        def sums(f: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            n, m = shape(f, g)
            p, both = _sigmoid(score), coarse[f] * m + coarse[g]
            return np.bincount(both, y - p, n * m).reshape(n, m), np.bincount(both, p * (1 - p), n * m).reshape(n, m), both

        usable = [f for f in range(len(bins)) if len(self.pair_cuts[f])]
        ranked = sorted(((_quadrants(*sums(f, g)[:2])[1], f, g) for f, g in combinations(usable, 2)), reverse=True)[:PAIRS]
        self.pairs = {(f, g): np.zeros(shape(f, g)) for _, f, g in ranked}
        for _ in range(PAIR_ROUNDS):
            for (f, g), table in self.pairs.items():
                gs, hs, both = sums(f, g)
                step = RATE * _quadrants(gs, hs)[0]
                table += step
                score += step.ravel()[both]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (c, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += t[np.searchsorted(c, x[:, f], side="left")]
        for (f, g), t in self.pairs.items():
            total += t[np.searchsorted(self.pair_cuts[f], x[:, f], side="left"), np.searchsorted(self.pair_cuts[g], x[:, g], side="left")]
        return _sigmoid(total)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Gam:
    """Fit on about ``SAMPLE_ROWS`` labelled rows, drawn by the id's hash; one row an id, whatever the number of its rows."""
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y")).filter("i IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("i").agg(F.max("y").alias("y"))
    total = known.count()
    if not total:
        return Gam()
    space = 1 << 40
    below = space if total <= SAMPLE_ROWS else space * SAMPLE_ROWS // total
    drawn = known.filter(F.pmod(F.xxhash64("i"), F.lit(space)) < below)
    measure = F.pandas_udf(lambda s: pd.Series(list(matrix(s))), "array<double>")
    rows = (
        docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
        .join(F.broadcast(drawn), "i")  # about SAMPLE_ROWS pairs of numbers
        .select("i", "y", measure("t").alias("x"))
        .groupBy("i", "y")  # of an id's rows the one with the smallest features, combined before the shuffle
        .agg(F.min("x").alias("x"))
        .toPandas()
    )
    if not len(rows):
        return Gam()
    rows = rows.sort_values("i")
    return Gam().fit(np.array(rows["x"].tolist()), rows["y"].to_numpy(float))


def score_column(model: Gam, text: str = "text") -> Column:
    """Score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts)))

    return score(F.col(text))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document; learned from the labels that are not held out."""
    docs = open_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = open_table(spark, sf_dir, "labels", "doc_id", "quality").filter(~held_out("doc_id"))
    model = learn(docs, labels)
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= GOOD, 1).otherwise(0))
