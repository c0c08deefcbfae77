"""Toxicity: maximum-scoring segments over token log-odds, calibrated by extreme-value statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from camadas.llm.common import MAX_LABELS, calibrated, calibration, label_sample, through, with_labels, words_of
from camadas.session import materialize

EDGE = b".,;:!?'\"()[]{}|*#%$&-"
# Prior occurrences of every unit, and what each token costs a segment; chosen by cross-validation on training rows.
PRIOR, DRIFT = 10.0, 0.5
# Log-odds nearer to 0 count as 0, mostly those of units seen once in clean texts; they need not be shipped.
EVEN = 0.125
# Scores are multiples of 1 / STEPS, so that their sums are exact.
STEPS = 1024
TOP, WORD_CACHE = 60.0, 500_000
BEGINNINGS = (4, 5, 6)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation at their edges; words of punctuation only become empty."""
    return [w.strip(EDGE) for w in words_of(text)]


def units(word: bytes) -> list[bytes]:
    """A word and its longer beginnings, which carry what inflected forms have in common."""
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]


def key_of(unit: bytes) -> int:
    """63 bits that stand for a unit."""
    return xxh3_64_intdigest(unit) >> 1


def token_counts(labelled: DataFrame) -> DataFrame:
    """(unit, whole, bad, good): counts by class of words and beginnings, combined per batch first."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = (Counter(), Counter())
            for text, y in zip(frame["text"], frame["y"]):
                counts[y].update(tokens(text))
            spread = (Counter(), Counter())
            for words, out in zip(counts, spread):
                for word, n in words.items():
                    for i, unit in enumerate(units(word)):
                        out[key_of(unit), i == 0] += n
            names = sorted(set(spread[0]) | set(spread[1]))
            yield pd.DataFrame({"unit": [u for u, _ in names], "whole": [w for _, w in names],
                                "bad": [spread[1][u] for u in names], "good": [spread[0][u] for u in names]})

    rows = labelled.mapInPandas(run, "unit long, whole boolean, bad long, good long")
    return rows.groupBy("unit", "whole").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


class Scores:
    """The score of each word: the mean log-odds of its units less ``DRIFT``; remembers the words seen.

    A unit that was not counted has log-odds 0, the value the prior alone gives.
    """

    def __init__(self, keys: np.ndarray, odds: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.odds = keys[order], odds[order]
        self.known: dict[bytes, float] = {}

    def learn(self, words: list[bytes]) -> None:
        spelled = [[key_of(u) for u in units(w)] for w in words]
        keys = np.array([k for own in spelled for k in own], dtype="i8")
        sizes = np.array([len(own) for own in spelled])
        odds = np.zeros(len(keys))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            odds = np.where(self.keys[at] == keys, self.odds[at], 0.0)
        means = np.add.reduceat(odds, np.cumsum(sizes) - sizes) / sizes
        self.known.update(zip(words, (np.round((means - DRIFT) * STEPS) / STEPS).tolist()))

    def of(self, words: list[bytes]) -> np.ndarray:
        distinct = set(words)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > WORD_CACHE:
            self.known.clear()
            new = distinct
        if new:
            self.learn(list(new))
        return np.fromiter(map(self.known.__getitem__, words), "f8", len(words))


def log_odds(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and shrunken log-odds of all counted units.

    The Dirichlet prior gives every unit ``PRIOR`` occurrences, dealt to the classes by their size, so a
    unit seen a few times stays near 0. What reaches the driver is 12 bytes for each distinct unit of the
    bounded label sample whose log-odds are ``EVEN`` or more, on either side.
    """
    counts = materialize(counts, "toxicity-counts")
    total = counts.where("whole").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    bad, good = total.bad or 0, total.good or 0
    if not bad or not good:
        return np.zeros(0, dtype="i8"), np.zeros(0, dtype="f4")

    def side(own: str, size: int) -> Column:
        return F.log(F.col(own) * ((bad + good) / size) + PRIOR)

    odds = counts.select("unit", (side("bad", bad) - side("good", good)).cast("float").alias("odds"))
    rows = odds.where(F.abs("odds") >= EVEN).toArrow()
    return rows.column("unit").to_numpy(), rows.column("odds").to_numpy()


def extreme_values(clean: DataFrame, scores: Scores) -> tuple[float, float]:
    """(rate, chance) of the segment statistics of clean texts.

    The rate solves mean(exp(rate * score)) = 1 over all their tokens, the chance is the share of tokens
    that score above zero. Tokens are counted by score in hundredths, so a bounded histogram is collected.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: Counter = Counter()
            for text in frame["text"]:
                places, n = np.unique(np.round(scores.of(tokens(text)) * 100).astype("i8"), return_counts=True)
                seen.update(dict(zip(places.tolist(), n.tolist())))
            yield pd.DataFrame({"place": list(seen), "n": list(seen.values())}, dtype="int64")

    rows = clean.select("text").mapInPandas(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    values, share = np.array([r.place for r in rows]) / 100, np.array([r.n for r in rows], dtype="f8")
    if not (values > 0).any():
        return 50.0, 1 / max(share.sum(), 1.0)
    share /= share.sum()
    low, high = 0.0, 50.0
    for _ in range(80):
        rate = (low + high) / 2
        low, high = (rate, high) if (share * np.exp(np.minimum(rate * values, 700))).sum() < 1 else (low, rate)
    return max(low, 1e-3), float(share[values > 0].sum())


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence of token scores.

    One scan from left to right over the positive tokens with the running sum; every candidate is merged
    or skipped once, so the time is linear.
    """
    found: list[list[float]] = []  # start, end, sum before, sum after, index of the nearest lower start
    sums = np.append(0.0, np.cumsum(scores))
    places = np.flatnonzero(scores > 0)
    for at, before, after in zip(places.tolist(), sums[places].tolist(), sums[places + 1].tolist()):
        item = [at, at + 1, before, after]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= item[3]:
                found.append([*item, j])
                break
            item = [found[j][0], item[1], found[j][2], item[3]]
            del found[j:]
    return [(int(s), int(e), right - left) for s, e, left, right, _ in found]


def passages(words: list[bytes], scores: Scores, rate: float, chance: float,
             worst: float = 0.05) -> tuple[list[tuple[int, int, float, float]], float]:
    """Significant segments with their E-values, and the document's evidence.

    A segment's E-value is words * chance * exp(-rate * score), the number of segments as good that a
    clean document of this length has by chance. The evidence sums -ln(E) over segments.
    """
    kept, evidence = [], 0.0
    for start, end, score in segments(scores.of(words)):
        expected = len(words) * chance * float(np.exp(-rate * score))
        if expected < worst:
            kept.append((start, end, score, expected))
        evidence += max(0.0, -np.log(max(expected, 1e-300)))
    return kept, float(np.log1p(evidence) * 10)


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.5,
                   max_labels: int = MAX_LABELS) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1), predicted, passages (start and end word, score, E-value).

    Fitted on at most ``max_labels`` rows of ``labels`` (doc_id, toxic) outside ``held_out``; labels other
    than 0 and 1 are ignored, a repeated label counts each time. Without labels of both classes there are
    no passages and every score is 0. Null and empty texts have no passage; null ids and repeated rows are
    scored like others; no rows give no rows; columns besides doc_id and text are ignored.
    """
    texts = docs.select("doc_id", "text")
    train = with_labels(texts, label_sample(labels, "toxic", held_out, max_labels)).select("text", "y")
    words = Scores(*log_odds(token_counts(train)))
    learned = len(words.keys) > 0
    rate, chance = extreme_values(train.where("y = 0"), words) if learned else (1.0, 1.0)

    def evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"raw": [passages(tokens(t), words, rate, chance)[1] for t in frame["text"]],
                                "y": frame["y"]})

    knots = calibration(train.mapInPandas(evidence, "raw double, y int"), 0.0, TOP) if learned else ([], [])

    def make(batch: pa.RecordBatch) -> dict:
        found = [passages(tokens(t), words, rate, chance) for t in batch.column("text").to_pylist()]
        raw = np.array([e for _, e in found])
        return {"score": np.clip(calibrated(raw, knots, 0.0), 0, 1), "passages": [
            [dict(zip(("start", "end", "score", "e_value"), p)) for p in kept] for kept, _ in found]}

    shape = "score double, passages array<struct<start:long,end:long,score:double,e_value:double>>"
    return through(texts, make, shape).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
