"""Document quality by pairwise preference: a Bradley-Terry model on the differences of text features."""

from __future__ import annotations

import itertools
import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .frames import beside, slices
from .words import SPACE_BYTES, Hasher, U, runs, starts_inside

SIGNS = string.punctuation
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
NAMES = [
    "log_words", "word_length", "word_length_sd", "upper", "digit", "not_ascii", "other", "line_breaks", "capital_starts", "sign_ends", "two_sign_ends", "letters_only", "long_words",
    "distinct_words", "distinct_fives", "same_as_last", "top_word",
] + [f"sign_{ord(c)}" for c in SIGNS]


def features(texts: pa.Array, hasher: Hasher) -> np.ndarray:
    """One row a text, of NAMES: rates of kinds of characters and words and of repetition, all between bounds that size doesn't move."""
    words, begin, end, firsts, data = hasher.batch(texts)
    n = len(firsts) - 1
    count = np.diff(firsts)
    some = np.maximum(count, 1)
    text = np.repeat(np.arange(n), count)
    ends = np.append(end, 0)
    size = end - begin
    bytes_ = np.maximum(np.bincount(text, size, n), 1)

    def by_word(x: np.ndarray) -> np.ndarray:
        return np.bincount(text, x, n) / some

    # how often each byte value occurs in each text: all rates of characters come from this
    firsts_of_text = np.append(begin, len(data))[firsts]
    owner = np.repeat(np.arange(n), np.diff(np.append(firsts_of_text[:-1], len(data)))) if n else np.zeros(0, np.int64)
    table = np.bincount(owner * 256 + data[len(data) - len(owner) :], minlength=n * 256).reshape(n, 256)[:, :256]

    def by_byte(mask: np.ndarray) -> np.ndarray:
        return table[:, mask & ~SPACE_BYTES].sum(1) / bytes_

    def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of distinct values, and of the most frequent one, among each owner's."""
        _, at, times = np.unique(values + owner.astype(U) * U(0x9E3779B97F4A7C15), return_index=True, return_counts=True)
        top = np.zeros(n)
        np.maximum.at(top, owner[at], times)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        return np.bincount(owner[at], minlength=n) / total, top / total

    last = data[np.maximum(ends[:-1] - 1, 0)] if len(words) else data[:0]
    before = data[np.maximum(end - 2, 0)] if len(words) else data[:0]
    sign = lambda x: ~(_LETTER[x] | _DIGIT[x])
    letters = np.append(0, np.cumsum(_LETTER[data]))
    mean = by_word(size)
    out = [np.log1p(count), mean, np.sqrt(np.maximum(by_word(size.astype(float) ** 2) - mean**2, 0)), by_byte(_UPPER), by_byte(_DIGIT)]
    high = np.zeros(256, bool)
    high[128:] = True
    out += [by_byte(high), by_byte(~(_LETTER | _DIGIT))]
    gap = np.zeros(len(words))
    if len(words):
        breaks = np.append(0, np.cumsum(data == 10))
        gap[1:] = breaks[begin[1:]] - breaks[end[:-1]]
        gap[firsts[:-1][count > 0]] = 0
    out += [by_word(gap), by_word(_UPPER[data[begin]]), by_word(sign(last)), by_word(sign(last) & sign(before) & (size > 2)), by_word(letters[end] - letters[begin] == size), by_word(size > 20)]
    share, top = distinct(words, text)
    out.append(share * np.log1p(some) / np.log1p(np.minimum(some, 200)))
    for k in (5,):
        inside = np.flatnonzero(starts_inside(firsts, k))
        out.append(distinct(runs(words, k)[inside], text[inside])[0])
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[firsts[:-1][count > 0]] = False
    out += [by_word(same), top]
    out += [np.minimum(10 * table[:, ord(c)] / bytes_, 1) for c in SIGNS]
    return np.column_stack(out)


@dataclass(frozen=True)
class Model:
    """raw = (features - mean) / scale . weights; score = 1 / (1 + exp(-slope * (raw - cut)))."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(x) - self.cut), -40, 40)))


def meetings(n_good: int, n_bad: int, opponents: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places among the good and the bad: every one of either meets `opponents` of the other.  The stride has no divisor in common with n_bad, so that none is passed over."""
    stride = next(k for k in itertools.count(7) if math.gcd(k, n_bad) == 1)
    turn = np.arange(max(n_good, n_bad))
    return [(turn % n_good, (turn * stride + k * (1 + n_bad // opponents)) % n_bad) for k in range(opponents)]


def fit(x: np.ndarray, y: np.ndarray, opponents: int = 8, l2: float = 1e-3, steps: int = 25) -> Model:
    """Weights by logistic loss on feature differences of (preferred, other) pairs; the cut is the score quantile with fewest errors.

    Every row of either label meets `opponents` rows of the other, spread
    evenly.  With one label alone, or no rows, weights are zero and every score
    is 1 or 0 after that label (1 without rows).
    """
    d = x.shape[1]
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        sign = 1.0 if len(good) or not len(y) else -1.0
        return Model(np.zeros(d), np.ones(d), np.zeros(d), -sign, 8.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    pairs = [(good[i], bad[j]) for i, j in meetings(len(good), len(bad), opponents)]
    diff = z[np.concatenate([p[0] for p in pairs])] - z[np.concatenate([p[1] for p in pairs])]
    w = np.zeros(d)
    for _ in range(steps):  # Newton's method
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        grad = -(diff * p[:, None]).mean(0) + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    # candidates are the quantiles of the scores; errors are balanced by label only through their number
    order = np.argsort(raw, kind="stable")
    label = y[order]
    wrong = np.append(0, np.cumsum(label == 1)) + np.append(np.cumsum((label == 0)[::-1])[::-1], 0)
    best = np.flatnonzero(wrong == wrong.min())
    k = int(best[len(best) // 2])
    values = raw[order]
    cut = (values[max(k - 1, 0)] + values[min(k, len(values) - 1)]) / 2
    spread = np.median(np.abs(raw - cut)) or 1.0
    return Model(mean, scale, w, float(cut), float(3 / spread))


def training_rows(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str, label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `most` labelled documents, taken by a hash of their ids."""
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    sample = known.where("id is not null").orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id").select("text", "label")  # `most` bounds what is broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in slices(batches, 1 << 20):
            x = features(batch.column(0), hasher)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    got = rows.mapInArrow(run, "x array<double>, label int").toArrow()
    x = got["x"].combine_chunks()
    return x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, len(NAMES))), got["label"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model fitted on at most `most` labelled documents (the bound of what the driver gathers); 1 is preferred to 0.

    Labels that are neither are left out; an id with several labels counts by the largest.
    """
    x, y = training_rows(docs, labels, most, id_col, text_col, label_col)
    order = np.lexsort((*x.T, y)) if len(y) else []  # the order of rows must not matter
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs, with score (0 to 1) and predicted (1 if score >= 0.5).  A null text counts as empty.

    Columns of these names are replaced.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        hasher = Hasher(lower=True)
        for part in texts:
            s = model.score(features(part, hasher))
            yield [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]

    return beside(docs, text_col, StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())]), run, instead=("score", "predicted"))
