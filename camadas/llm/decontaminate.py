"""Benchmark decontamination by latent semantic retrieval, with subsequence and answer checks.

Passages of the corpus and of the benchmark are TF-IDF vectors over hashed words. A randomised SVD gives
the latent space: each task multiplies its passages by a random sign matrix (one non-zero per passage), the
products are summed over tasks, and the driver decomposes the small sum beside the benchmark's own
rows. Windows whose latent cosine with a benchmark passage is high enough are judged first; a longest common
subsequence of words, and one with the item's answer, decide.

Retrieval only orders the work. A subsequence cannot be longer than the number of the item's words that
stand in the stretch at all, so that number admits every stretch that can hold a leak, and all its windows are judged.

Up to there words are 15-bit numbers, under which different words may look equal: that can add pairs, not lose any.
What is left is judged once more on the words themselves.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camadas.llm.common import partial_sums, through, words_of
from camadas.session import materialize

# Documents with a pair that may be broadcast to their texts: an id and a few item ids each.
BROADCAST_DOCS = 1_000_000

FEATURES, SKETCH_ROWS, RANK = 8192, 64, 128
# Words are kept as 15-bit numbers whose low 13 bits are their feature; the last feature stands for
# words of punctuation only and for filling, and weighs nothing.
NOTHING = FEATURES - 1
STEP = 16
PASSAGE = 2 * STEP
COSINE = 0.5
STRETCH = 256
ITEMS_AT_ONCE = 2000
PASSAGES_AT_ONCE = 32
TOKENS_AT_ONCE = 100_000
WORD_CACHE = 500_000
EDGE = b".,;:!?'\"()[]{}|*#%$&-"


class Numbers(dict):
    """The number of each word without the punctuation at its edges."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(EDGE)
        h = xxhash.xxh3_64_intdigest(bare)
        self[word] = number = (h % NOTHING) | ((h >> 40) % 4 * FEATURES) if bare else NOTHING
        return number

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self) > WORD_CACHE:
            self.clear()
        words = words_of(text)
        return np.fromiter(map(self.__getitem__, words), "i2", len(words))


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, words): whole texts as word numbers, so that every later pass is arithmetic."""
    def make(batch: pa.RecordBatch) -> dict:
        numbers = Numbers()
        return {"words": [numbers(t).tobytes() for t in batch.column("text").to_pylist()]}

    return through(docs.select("doc_id", "text"), make, "words binary")


def filled(rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of texts in rows of ``width``, each text's last one filled up, and each row's text."""
    counts = np.array([-(-len(r) // width) for r in rows])
    grid = np.full((int(counts.sum()), width), NOTHING, "i2")
    flat = grid.reshape(-1)
    at = 0
    for r, n in zip(rows, counts.tolist()):
        flat[at:at + len(r)] = r
        at += n * width
    return grid & (FEATURES - 1), np.repeat(np.arange(len(rows)), counts)


def corpus_moments(docs: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of passages, passages per feature, and the sign-sketched sum of passages (rows x features).

    Inverse document frequency scales columns, so it can be applied to the summed sketch afterwards. A
    passage's random row and sign come from its own words, so a repeated task adds the same.
    """
    def measure(frame: pd.DataFrame) -> np.ndarray:
        count, seen, sketch = 0, np.zeros(FEATURES), np.zeros(SKETCH_ROWS * FEATURES)
        for at in range(0, len(frame), 512):
            rows = [np.frombuffer(b, "i2") for b in frame["words"].iloc[at:at + 512]]
            grid = np.sort(filled(rows, PASSAGE)[0], axis=1)
            if not len(grid):
                continue
            mixed = (grid.astype("u8") * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).sum(axis=1, dtype="u8")
            lane, sign = (mixed % np.uint64(SKETCH_ROWS)).astype("i4"), 1.0 - 2.0 * ((mixed >> np.uint64(17)) & np.uint64(1))
            places = lane[:, None] * FEATURES + grid
            sketch += np.bincount(places.ravel(), np.repeat(sign, PASSAGE), len(sketch))
            new = np.ones(grid.shape, bool)
            new[:, 1:] = grid[:, 1:] != grid[:, :-1]
            seen += np.bincount(grid[new], minlength=FEATURES)
            count += len(grid)
        return np.concatenate([[count], seen, sketch])

    total = partial_sums(docs.select("words"), measure)
    if total is None:
        total = np.zeros(1 + FEATURES * (1 + SKETCH_ROWS))
    return total[0], total[1:1 + FEATURES], total[1 + FEATURES:].reshape(SKETCH_ROWS, FEATURES)


@dataclass
class Item:
    """A benchmark item: its words, and the words of its answer (the last line, else the last sentence)."""

    item_id: int
    words: np.ndarray
    answer: np.ndarray


def last_part(text: str) -> str:
    """The last line of a text of several lines, else its last sentence: where an item has its answer."""
    lines = [x for x in text.strip().split("\n") if x.strip()]
    return lines[-1] if len(lines) > 1 else (re.split(r"(?<=[.!?])\s+", text.strip()) or [""])[-1]


def as_item(item_id: int, text: str) -> Item:
    numbers = Numbers()
    return Item(item_id, numbers(text), numbers(last_part(text)))


def latent_basis(blocks: Callable[[], Iterator[np.ndarray]], rank: int, rounds: int = 4, more: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values of the stacked blocks, and their right vectors (rank x features).

    Orthogonal iteration from random directions: besides one block at a time only matrices of ``rank + more`` columns are held.
    """
    rng = np.random.default_rng(5)
    width = min(sum(len(x) for x in blocks()), rank + more)
    directions = np.linalg.qr(rng.normal(size=(FEATURES, width)))[0]
    for _ in range(rounds):
        seen = np.linalg.qr(np.vstack([x @ directions for x in blocks()]))[0]
        back, at = np.zeros((FEATURES, width)), 0
        for x in blocks():
            back += x.T @ seen[at:at + len(x)]
            at += len(x)
        directions = np.linalg.qr(back)[0]
    _, strength, turn = np.linalg.svd(np.vstack([x @ directions for x in blocks()]), full_matrices=False)
    kept = np.flatnonzero(strength > 1e-6)[:rank]
    return strength[kept], (directions @ turn[kept].T).T


class Index:
    """Latent vectors of a bounded set of benchmark items, and the projection of every feature.

    Passages of items are made dense a few at a time, so the driver holds no matrix of items by features.
    """

    def __init__(self, items: list[Item], count: float, seen: np.ndarray, sketch: np.ndarray) -> None:
        self.items = [i for i in items if (i.words != NOTHING).any()]
        self.sizes = np.array([len(i.words) for i in self.items], "i8")
        self.longest = int(self.sizes.max(initial=0))
        pieces, owner = [], []
        for k, item in enumerate(self.items):
            f = item.words & (FEATURES - 1)
            for at in range(0, max(1, len(f) - STEP // 2), 3 * STEP // 2):
                pieces.append(f[at:at + PASSAGE])
                owner.append(k)
        self.owner = np.array(owner)
        idf = np.log((1 + count + len(pieces)) / (1 + seen))
        idf[NOTHING] = 0

        def unit(rows: np.ndarray) -> np.ndarray:
            rows = rows * idf
            rows /= np.linalg.norm(rows, axis=1, keepdims=True) + 1e-12
            return rows

        def passages() -> Iterator[np.ndarray]:
            for at in range(0, len(pieces), PASSAGES_AT_ONCE):
                yield unit(np.array([np.bincount(p, minlength=FEATURES) for p in pieces[at:at + PASSAGES_AT_ONCE]], "f8"))

        def blocks() -> Iterator[np.ndarray]:
            for at in range(0, len(sketch), PASSAGES_AT_ONCE):
                yield unit(sketch[at:at + PASSAGES_AT_ONCE])
            yield from passages()

        strength, basis = latent_basis(blocks, RANK)
        # Rows have length one: a ridge of one keeps a passage and the item it holds alike where both are among few rows.
        scale = 1 / np.sqrt(strength**2 + 1)
        self.project = np.ascontiguousarray((basis * scale[:, None]).T * idf[:, None], dtype="f4")
        latent = np.vstack([np.zeros((0, len(basis))), *((rows @ basis.T) * scale for rows in passages())])
        self.latent = (latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-12)).astype("f4")

    @cached_property
    def counts(self) -> np.ndarray:
        """How often each word stands in each item; made by the tasks, so it is not sent to them."""
        counts = np.zeros((4 * FEATURES, len(self.items)), np.min_scalar_type(self.longest))
        for k, item in enumerate(self.items):
            np.add.at(counts[:, k], item.words, 1)
        return counts

    def candidates(self, rows: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(text, first word of the window, item) with a high cosine, for texts given as features."""
        grid, text = filled(rows, STEP)
        columns = np.ascontiguousarray(grid.T)
        sums = self.project[columns[0]]
        for k in range(1, STEP):
            sums += self.project[columns[k]]
        windows = sums.copy()
        together = np.flatnonzero(text[1:] == text[:-1])
        windows[together] += sums[together + 1]
        norms = np.sqrt(np.einsum("ij,ij->i", windows, windows))
        windows /= np.maximum(norms, 1e-9)[:, None]
        near = windows @ self.latent.T >= COSINE
        places = np.flatnonzero(near)
        first = np.searchsorted(text, np.arange(len(rows)))
        at, piece = places // near.shape[1], places % near.shape[1]
        found = np.unique(at * len(self.items) + self.owner[piece]) if len(places) else places
        for key in found.tolist():
            w, k = divmod(key, len(self.items))
            yield int(text[w]), int(w - first[text[w]]) * STEP, k


    def admitted(self, words: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
        """(first word of a stretch, item) where a window may hold ``least`` of the item in order.

        Counts the item's words, repeats included, that stand anywhere in the regions of the stretch's windows.
        """
        for at in range(0, len(words), STRETCH):
            there = np.unique(words[max(0, at - self.longest):at + STRETCH + PASSAGE + self.longest])
            most = self.counts[there].sum(axis=0, dtype="u4") / self.sizes
            for k in np.flatnonzero(most >= least).tolist():
                yield at, k


def common_subsequence(pattern: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the pattern."""
    places: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    full = (1 << len(pattern)) - 1
    state = full
    for w in words.tolist():
        match = places.get(w)
        if match:
            hit = state & match
            state = ((state + hit) | (state - hit)) & full
    return len(pattern) - state.bit_count()


def verdict(item: Item, holds: np.ndarray, words: np.ndarray, at: int, least: float, least_with_answer: float) -> tuple[float, float] | None:
    """Shares of the item and of its answer found in order around a window, if they are enough.

    ``holds`` counts the item's words: a region with fewer of them cannot hold a long subsequence.
    """
    size = len(item.words)
    region = words[max(0, at - size):at + PASSAGE + size]
    region = region[holds[region] > 0]
    if len(region) < least_with_answer * size:
        return None
    share = common_subsequence(item.words, region) / size
    if share < least_with_answer:
        return None
    answer = common_subsequence(item.answer, region) / len(item.answer) if len(item.answer) else 1.0
    return (share, answer) if share >= least or answer >= 0.8 else None


def possible(item: Item, holds: np.ndarray, words: np.ndarray, at: int, least: float) -> bool:
    """Whether the regions of a stretch's windows, taken together, hold ``least`` of the item in order."""
    size = len(item.words)
    region = words[max(0, at - size):at + STRETCH + PASSAGE + size]
    region = region[holds[region] > 0]
    return len(region) >= least * size and common_subsequence(item.words, region) / size >= least


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.7, least_with_answer: float = 0.55) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, lcs_share, answer_share (the best of the document's windows).

    A document is contaminated by an item if at least ``least`` of the item's words appear in it in order
    within the item's size around any window of ``PASSAGE`` words, or ``least_with_answer`` of them along with
    four fifths of the answer. Words are equal if their bytes are, A-Z lower-cased and without the punctuation at
    their edges. The benchmark is read in blocks of about ``ITEMS_AT_ONCE`` items, each with
    a pass of its own over the documents, so what tasks receive is bounded.

    Null and empty texts and items match nothing, as do null item ids; a null doc_id is reported as null;
    repeated rows give one pair; empty tables give no rows; other columns are ignored.
    """
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    n = items.count()
    texts = materialize(numbered(docs.where("text is not null")), "leak-words")
    out = None
    moments = corpus_moments(texts) if n else None
    lots = max(1, -(-n // ITEMS_AT_ONCE))
    for lot in range(lots):
        some = items.where(F.pmod(F.xxhash64("item_id", F.lit(3)), F.lit(lots)) == lot) if lots > 1 else items
        index = Index([as_item(r.item_id, r.text) for r in some.collect()], *moments) if n else None
        likely = materialize(search(texts, index, least, least_with_answer).select("doc_id", "item_id").distinct(), "leak-pairs")
        pairs = confirmed(docs, some, likely, least, least_with_answer)
        out = pairs if out is None else out.unionByName(pairs)
    best = F.max(F.struct("lcs_share", "answer_share")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.lcs_share", "b.answer_share")


def search(texts: DataFrame, index: Index | None, least: float, least_with_answer: float) -> DataFrame:
    names = ["doc_id", "item_id", "lcs_share", "answer_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if index is None or not index.items:
                continue
            found: list[tuple] = []
            held: list[tuple] = []

            def flush() -> None:
                open_ = [(k, at, i) for k, (_, words) in enumerate(held) for at, i in index.admitted(words, least_with_answer)
                         if possible(index.items[i], index.counts[:, i], words, at, least_with_answer)]
                hopeful, judged = set(open_), set()
                best: dict[tuple[int, int], tuple[float, float]] = {}

                def judge(k: int, at: int, i: int) -> None:
                    if (k, at, i) not in judged and best.get((k, i)) != (1.0, 1.0):
                        judged.add((k, at, i))
                        shares = verdict(index.items[i], index.counts[:, i], held[k][1], at, least, least_with_answer)
                        if shares:
                            best[k, i] = max(shares, best.get((k, i), shares))

                for k, at, i in index.candidates([words for _, words in held]) if hopeful else ():
                    if (k, at // STRETCH * STRETCH, i) in hopeful:
                        judge(k, at, i)
                for k, start, i in open_:
                    for at in range(start, min(start + STRETCH, len(held[k][1])), STEP):
                        judge(k, at, i)
                found.extend((held[k][0], index.items[i].item_id, *shares) for (k, i), shares in best.items())

            size = 0
            for doc, blob in zip(batch.column("doc_id").to_pylist(), batch.column("words").to_pylist()):
                if blob:
                    held.append((doc, np.frombuffer(blob, "i2")))
                    size += len(blob) // 2
                if size >= TOKENS_AT_ONCE:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            columns = list(zip(*found)) if found else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names)

    return texts.mapInArrow(run, "doc_id long, item_id long, lcs_share double, answer_share double")


def bare_words(text: str | None) -> list[bytes]:
    """Words without the punctuation at their edges; words of punctuation only become empty."""
    return [w.strip(EDGE) for w in words_of(text)]


class Exact:
    """One item by its own words: places of a text that cannot hold one of them are skipped without a search."""

    def __init__(self, item_id: int, text: str) -> None:
        words, answer = bare_words(text), bare_words(last_part(text))
        self.known = {w: k for k, w in enumerate(dict.fromkeys(words))}
        self.item = Item(item_id, *(np.array([self.known[w] for w in ws], "i8") for ws in (words, answer)))
        self.holds = np.append(np.bincount(self.item.words, minlength=len(self.known)), 0)

    def best(self, words: list[bytes], least: float, least_with_answer: float) -> tuple[float, float] | None:
        """The highest shares around any window of a text."""
        size, other = len(self.item.words), len(self.known)
        numbers = np.fromiter((self.known.get(w, other) for w in words), "i8", len(words))
        before = np.append(0, np.cumsum(numbers != other))
        starts = np.arange(0, len(words), STEP)
        held = before[np.minimum(starts + PASSAGE + size, len(words))] - before[np.maximum(starts - size, 0)]
        found = None
        for at in starts[held >= least_with_answer * size].tolist():
            shares = verdict(self.item, self.holds, numbers, at, least, least_with_answer)
            if shares and (found is None or shares > found):
                found = shares
            if found == (1.0, 1.0):
                break
        return found


def confirmed(docs: DataFrame, items: DataFrame, likely: DataFrame, least: float, least_with_answer: float) -> DataFrame:
    """The likely pairs that are leaks by their words. Texts meet the items found for their id; where one id has several
    texts, each is judged. ``items`` are at most one lot."""
    by_doc = likely.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")).withColumnRenamed("doc_id", "likely_id")
    by_doc = F.broadcast(by_doc) if likely.count() <= BROADCAST_DOCS else by_doc
    texts = docs.select("doc_id", "text").where("text is not null").join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("likely_id"))).select("doc_id", "text", "items")
    known = [(r.item_id, r.text) for r in items.collect()]
    names = ["doc_id", "item_id", "lcs_share", "answer_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact: dict[int, list[Exact]] = {}
        for item_id, text in known:
            exact.setdefault(item_id, []).append(Exact(item_id, text))
        for batch in batches:
            found: list[tuple] = []
            for doc, text, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items"))):
                words = bare_words(text)
                for item in (e for i in ids for e in exact[i] if any(e.known)):
                    shares = item.best(words, least, least_with_answer)
                    if shares:
                        found.append((doc, item.item.item_id, *shares))
            columns = list(zip(*found)) if found else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names)

    return texts.mapInArrow(run, "doc_id long, item_id long, lcs_share double, answer_share double")
