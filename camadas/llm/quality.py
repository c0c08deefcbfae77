"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.llm.common import (
    MAX_LABELS, calibrated, calibration, label_sample, partial_sums, through, with_labels, words_of)
from camadas.session import materialize

STATISTICS = (
    "log_words", "word_length", "upper", "lower", "digits", "punctuation", "symbols", "wide",
    "spaces", "distinct", "repeated", "shouted", "longest_run", "top_share", "single", "line_words",
    "stuck", "long_words",
)
_KIND = np.full(256, 7)
_KIND[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "u1")] = 0
_KIND[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", "u1")] = 1
_KIND[np.frombuffer(b"0123456789", "u1")] = 2
_KIND[np.frombuffer(b".,;:!?'\"-()", "u1")] = 3
_KIND[np.frombuffer(b"#$%&*+/<=>@[]\\^_`{|}~", "u1")] = 4
_KIND[128:] = 5
_KIND[np.frombuffer(b" \t\r\n\x0b\x0c", "u1")] = 6
_STUCK = re.compile(rb"[!?#$%&*|@~^=+<>]{2,}")


def statistics(text: str | None) -> list[float]:
    """The document statistics of a whole text; an empty or null text has all zeros."""
    words = words_of(text)
    if not words:
        return [0.0] * len(STATISTICS)
    raw, n = text.encode(), len(words)
    shares = np.bincount(_KIND, np.bincount(np.frombuffer(raw, "u1"), minlength=256), 8) / len(raw)
    same = list(map(eq, words, words[1:]))
    run = longest = 0
    if any(same):
        for s in same:
            run = run + 1 if s else 0
            longest = max(longest, run)
    distinct = set(words)
    repeats = {}
    for w in compress(words, same + [False]):
        repeats[w] = repeats.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), "i4", n)
    return [
        np.log1p(n), float(lengths.mean()), shares[0], shares[1], shares[2], shares[3], shares[4],
        shares[5], shares[6], len(distinct) / n, sum(same) / n, shares[0] / (shares[0] + shares[1] + 1e-9),
        np.log1p(longest), max(repeats.values(), default=0) / n, float((lengths == 1).mean()),
        np.log1p(n / (1 + raw.count(b"\n"))), len(_STUCK.findall(raw)) / n, float((lengths > 20).mean()),
    ]


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document, read once."""
    def make(batch: pa.RecordBatch) -> dict:
        return {"x": [np.asarray(statistics(t), "f4") for t in batch.column("text").to_pylist()]}

    return through(docs.select("doc_id", "text"), make, "x array<float>")


class Fourier:
    """Random features whose inner products approximate a Gaussian kernel on standardised statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, width: float, size: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.size = mean, scale, size
        self.directions = rng.normal(size=(len(mean), size)) / width
        self.phases = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, xs: pd.Series) -> np.ndarray:
        x = np.clip((np.stack(xs.to_numpy()) - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(x @ self.directions + self.phases) * np.sqrt(2 / self.size), np.ones((len(x), 1))])


class Model:
    """A fitted scorer; ``features`` is None where the labels had a single class or none."""

    def __init__(self, features: Fourier | None, solution: np.ndarray | None, knots, base: float) -> None:
        self.features, self.solution, self.knots, self.base = features, solution, knots, base

    def raw(self, xs: pd.Series) -> np.ndarray:
        return self.features(xs) @ self.solution

    def __call__(self, xs: pd.Series) -> np.ndarray:
        if self.features is None or not len(xs):
            return np.full(len(xs), self.base)
        return calibrated(self.raw(xs), self.knots, self.base)


def fit(described: DataFrame, sample: DataFrame, size: int = 256, width: float = 3.0, ridge: float = 1e-3,
        seed: int = 7) -> Model:
    """Ridge over random Fourier features: each partition adds up its normal equations, (size+1)^2 sums."""
    train = materialize(with_labels(described, sample).select("x", "y"), "quality-train")
    d = len(STATISTICS)

    def moments(frame: pd.DataFrame) -> np.ndarray:
        x = np.stack(frame["x"].to_numpy()).astype("f8")
        return np.concatenate([x.sum(0), (x * x).sum(0), [len(x), frame["y"].sum()]])

    total = partial_sums(train, moments)
    if total is None or total[-1] in (0.0, total[-2]):
        return Model(None, None, None, 0.5 if total is None else (total[-1] + 0.5) / (total[-2] + 1))
    n, mean = total[-2], total[:d] / total[-2]
    scale = np.sqrt(np.maximum(total[d:2 * d] / n - mean**2, 0)) + 1e-6
    features = Fourier(mean, scale, width, size, seed)

    def normal(frame: pd.DataFrame) -> np.ndarray:
        z = features(frame["x"])
        return np.hstack([z.T @ z, z.T @ frame["y"].to_numpy("f8")[:, None]])

    sums = partial_sums(train, normal).reshape(size + 1, size + 2)
    model = Model(features, np.linalg.solve(sums[:, :-1] + ridge * n * np.eye(size + 1) / size, sums[:, -1]), None,
                  total[-1] / n)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"raw": model.raw(frame["x"]), "y": frame["y"]})

    model.knots = calibration(train.mapInPandas(score, "raw double, y int"), -0.5, 1.5)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7,
                  max_labels: int = MAX_LABELS) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1, higher for label 1), predicted (score >= threshold).

    Fitted on at most ``max_labels`` rows of ``labels`` (doc_id, quality) outside ``held_out``; labels
    other than 0 and 1, and ids without a document, are ignored; a repeated label counts each time.
    Without labels of both classes every score is the base rate (0.5 without any). Null and empty texts
    have zero statistics and get that point's score; null ids and repeated rows are scored like others;
    no rows give no rows; columns besides doc_id and text are ignored.
    """
    described = materialize(describe(docs), "quality-statistics")
    model = fit(described, label_sample(labels, "quality", held_out, max_labels))

    def make(batch: pa.RecordBatch) -> dict:
        return {"score": np.clip(model(batch.column("x").to_pandas()), 0.0, 1.0)}

    return through(described, make, "score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7,
              max_labels: int = MAX_LABELS) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns, decided row by row.

    Without labels of both classes nothing is known against any row, and all are kept.
    """
    described = materialize(describe(docs), "quality-statistics")
    model = fit(described, label_sample(labels, "quality", held_out, max_labels))
    if model.features is None:
        return docs
    # Columns by number on the way through Arrow, whatever they are called.
    plain = [f"c{i}" for i in range(len(docs.columns))]
    text = plain[docs.columns.index("text")]

    def make(batch: pa.RecordBatch) -> dict:
        found = pd.Series([np.asarray(statistics(t), "f4") for t in batch.column(text).to_pylist()])
        return {"score": np.clip(model(found), 0.0, 1.0)}

    scored = through(docs.toDF(*plain), make, "score double", keep=tuple(plain))
    return scored.where(F.col("score") >= threshold).select(*plain).toDF(*docs.columns)
