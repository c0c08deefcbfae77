"""Language identification by unigrams over a fixed piece vocabulary, summed over all segmentations."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.llm.common import through

LETTER = regex.compile(r"\p{L}")
UNKNOWN, SMOOTHING = 1e-7, 0.5
# Far above the smallest float: one more piece cannot fall from here to zero.
SMALL = 1e-100
# Characters of the words scored at once, and of the words remembered; neither changes a score.
AT_ONCE, REMEMBERED = 200_000, 8_000_000
# Words after which more text no longer sharpens the score; the argmax does not depend on it.
SURE = 30.0
_P = np.uint64(1099511628211)


def normal(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def lettered(words: Iterable[str]) -> list[str]:
    """The words that hold a letter; others tell no language apart."""
    return [w for w in words if LETTER.search(w)]


def piece_counts(train: DataFrame, model_file: str) -> DataFrame:
    """(lang, piece, n): how often the public vocabulary's pieces occur, counted over all training texts."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sentencepiece import SentencePieceProcessor

        encoder = SentencePieceProcessor(model_file=model_file)
        for frame in frames:
            by_lang: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(frame["lang"], frame["text"]):
                by_lang[lang].update(normal(text))
            for lang, words in by_lang.items():
                counts = np.zeros(encoder.vocab_size())
                names = lettered(words)
                for ids, n in zip(encoder.encode(names, num_threads=1), map(words.__getitem__, names)):
                    for i in ids:
                        counts[i] += n
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "piece": used, "n": counts[used].astype("i8")})

    rows = train.select("lang", "text").mapInPandas(run, "lang string, piece int, n long")
    return rows.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class Pieces:
    """Per-language piece probabilities with a hashed lookup; scores words by the forward sum."""

    def __init__(self, model_file: str, counts: list[tuple[str, int, int]]) -> None:
        from sentencepiece import SentencePieceProcessor

        encoder = SentencePieceProcessor(model_file=model_file)
        usable = [i for i in range(encoder.vocab_size()) if not (
            encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i))]
        texts = {i: encoder.id_to_piece(i) for i in usable}
        self.longest = max(map(len, texts.values()))
        self.langs = sorted({lang for lang, _, _ in counts})
        place = {i: k for k, i in enumerate(texts)}
        table = np.full((len(texts), len(self.langs)), SMOOTHING)
        for lang, piece, n in counts:
            if piece in place:
                table[place[piece], self.langs.index(lang)] += n
        table /= table.sum(axis=0)
        keys = np.array([self._hash(t) for t in texts.values()], dtype="u8")
        order = np.argsort(keys)
        self.keys = keys[order]
        self.probabilities = np.vstack([table[order], np.zeros((1, len(self.langs)))])
        self.known: dict[str, int] = {}
        self.held = 0
        self.scores = np.zeros((0, len(self.langs)))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 14695981039346656037
        for c in piece:
            h = ((h ^ ord(c)) * int(_P)) & (2**64 - 1)
        return h

    def _find(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, len(self.keys))

    def _ending(self, codes: np.ndarray, since: int, until: int) -> np.ndarray:
        """Place in the table of the piece of size ``s`` that ends with character ``j``, as [word, j - since, s - 1]."""
        first = max(since - self.longest + 1, 0)
        out = np.full((len(codes), until - since, self.longest), len(self.keys), dtype="i4")
        keys = np.full((len(codes), until - first), 14695981039346656037, dtype="u8")
        for size in range(1, min(self.longest, until - first) + 1):
            keys = (keys[:, :until - first - size + 1] ^ codes[:, first + size - 1:until]) * _P
            skip = max(since - first - size + 1, 0)
            out[:, first + size - 1 + skip - since:, size - 1] = self._find(keys[:, skip:])
        return out

    def forward(self, words: list[str]) -> np.ndarray:
        """log P(word) per language: the sum over all segmentations, for words of one length, whatever it is.

        ``reach[:, j]`` is the probability of the characters before ``j``, over ``exp(shift)`` of its word and
        language: where it gets small, it and what the next positions look back on are scaled up. Only as much
        is kept as the longest piece looks back. A character that no piece covers counts as one unknown
        piece, alike in all languages.
        """
        n, back = len(words[0]) + 1, self.longest
        codes = np.array([list(map(ord, "▁" + w)) for w in words], dtype="u8")
        block = max(AT_ONCE // len(words), 1)
        reach = np.zeros((len(words), back + min(block, n), len(self.langs)))
        reach[:, back - 1] = 1
        shift = np.zeros((len(words), len(self.langs)))
        for since in range(0, n, block):
            until = min(since + block, n)
            pieces = self._ending(codes, since, until)
            found = pieces < len(self.keys)
            sizes = found[:, :, 1:].any(axis=0)
            for j in range(until - since):
                one = np.where(found[:, j, :1], self.probabilities[pieces[:, j, 0]], UNKNOWN)
                now = reach[:, j + back - 1] * one
                for size in np.flatnonzero(sizes[j]) + 2:
                    hit = np.flatnonzero(found[:, j, size - 1])
                    now[hit] += reach[hit, j + back - size] * self.probabilities[pieces[hit, j, size - 1]]
                reach[:, j + back] = now
                if now.min(initial=1) < SMALL:
                    scale = np.where(now < SMALL, now, 1)
                    shift += np.log(scale)
                    reach[:, j + 1:j + back + 1] /= scale[:, None]
            reach[:, :back] = reach[:, until - since:until - since + back].copy()
        return np.log(reach[:, back - 1]) + shift

    def score(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)))
        same: dict[int, list[int]] = defaultdict(list)
        for k, w in enumerate(words):
            same[len(w)].append(k)
        for size, places in same.items():
            step = min(max(AT_ONCE // (size + 1), 1), 20_000)
            for at in range(0, len(places), step):
                some = places[at:at + step]
                out[some] = self.forward([words[k] for k in some])
        return out

    def __call__(self, texts: list[str | None], cache: int = 400_000) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its share of the posterior."""
        split = [normal(t) if t and LETTER.search(t) else [] for t in texts]
        distinct = {w for words in split for w in words}
        new = distinct.difference(self.known)
        size = sum(map(len, new))
        if len(self.known) + len(new) > cache or self.held + size > REMEMBERED:
            self.known, self.scores, new = {}, self.scores[:0], distinct
            self.held, size = 0, sum(map(len, new))
        if new:
            self.held += size
            told = lettered(new)
            plain = list(new.difference(told))  # no letters: nothing said for any language
            start = len(self.scores)
            self.known.update(zip(told + plain, range(start, start + len(new))))
            self.scores = np.vstack([self.scores, self.score(told), np.zeros((len(plain), len(self.langs)))])
        names, best = [], np.zeros(len(texts))
        for k, words in enumerate(split):
            if not words or not self.langs:
                names.append("und")
                continue
            total = self.scores[np.fromiter(map(self.known.__getitem__, words), "i8", len(words))].sum(axis=0)
            total = (total - total.max()) * min(1.0, SURE / len(words))
            odds = np.exp(total)
            top = int(np.argmax(odds))
            names.append(self.langs[top])
            best[k] = odds[top] / odds.sum()
        return names, best


def identify(docs: DataFrame, held_out: Column, model_file: str) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from texts whose ``lang`` is known outside ``held_out``; the counts that reach the driver are
    bounded by languages times vocabulary. A null or letterless text is ``und`` with score 0, as is every
    text when nothing could be learned; equal scores go to the language first by name; null ids and
    repeated rows are scored like others; no rows give no rows; other columns are ignored.
    """
    marked = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out)
    train = marked.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = [(r.lang, r.piece, r.n) for r in piece_counts(train, model_file).collect()]
    pieces = Pieces(model_file, counts)

    def make(batch: pa.RecordBatch) -> dict:
        names, scores = pieces(batch.column("text").to_pylist())
        return {"lang_pred": names, "score": scores}

    return through(marked.drop("lang"), make, "lang_pred string, score double", keep=("doc_id", "held_out"))
