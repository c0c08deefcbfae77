"""Packing documents into sequences: shortest-pack-first over the histogram of lengths.

Full stretches of a document are sequences of their own. What is left of the documents is known to the
planner by the histogram of lengths alone. It places lengths longest first into the packs with most room,
many equal pieces into many equal packs at a time, so that its work depends on the sequence length only and
not on the number of documents. Packs are opened for exactly the tokens there are: as many of full length as
the total holds, and one for each power of two of the rest, which needs no padding. A length that no pack
has room for is cut: the shortest pack is filled, and what remains goes back into the histogram.

Placements name intervals of ranks within a length; a document finds its own by its rank.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict, deque
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camadas.llm.common import byte_letters, parts
from camadas.session import materialize

LENGTH = 2048
WORDS, CHARS = 300_000, 6_000_000
STOPS = ".,;:!?#$%&*+-/=@^_~()[]{}<>|\\\""
LATIN_END = "Ā"
LATIN_WORD = r"\A[A-Za-zªµºÀ-ÖØ-öø-ÿ]+\z"


class Placement(NamedTuple):
    """``count`` pieces, of the documents' rests of ``origin`` ids with ranks from ``rank`` on: the ids from
    ``start`` on, ``length`` of them, stand at ``offset`` of the sequences from ``sequence`` on."""

    origin: int
    rank: int
    count: int
    start: int
    length: int
    sequence: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = LENGTH) -> list[Placement]:
    """Placements of all pieces: longest first, each into the shortest packs. No pack has room left."""
    total = sum(length * count for length, count in histogram.items())
    packs = [(-capacity, 0, total // capacity, capacity)] if total >= capacity else []
    opened = total // capacity
    for bit in reversed(range(capacity.bit_length())):
        if total % capacity >> bit & 1:
            packs.append((-(1 << bit), opened, 1, 1 << bit))
            opened += 1
    heapq.heapify(packs)
    waiting: dict[int, deque] = defaultdict(deque)
    for length, count in histogram.items():
        if count:
            waiting[length].append((length, 0, count, 0))
    out = []
    for length in range(capacity, 0, -1):
        pieces = waiting.pop(length, ())
        while pieces:
            origin, rank, count, start = pieces.popleft()
            room, sequence, equal, size = heapq.heappop(packs)
            taken, fits = min(count, equal), min(length, -room)
            out.append(Placement(origin, rank, taken, start, fits, sequence, size + room))
            if -room > fits:
                heapq.heappush(packs, (room + fits, sequence, taken, size))
            if equal > taken:
                heapq.heappush(packs, (room, sequence + taken, equal - taken, size))
            if count > taken:
                pieces.appendleft((origin, rank + taken, count - taken, start))
            if length > fits:
                waiting[length - fits].append((origin, rank, taken, start + fits))
    return out


class Placed:
    """Placements by (origin, start), to look up the pieces of a rest by its rank."""

    def __init__(self, placements: list[Placement]) -> None:
        self.found: dict[tuple[int, int], list[Placement]] = defaultdict(list)
        for p in sorted(placements):
            self.found[p.origin, p.start].append(p)
        self.ranks = {k: [p.rank for p in v] for k, v in self.found.items()}

    def pieces(self, origin: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of the rest, in order."""
        start = 0
        while start < origin:
            key = origin, start
            p = self.found[key][bisect_right(self.ranks[key], rank) - 1]
            yield start, p.length, p.sequence + rank - p.rank, p.offset
            start += p.length


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian 32-bit integers.

    A vocabulary that drops white space never joins what stands on both sides of it, so a text's ids are
    those of its chunks between blanks. A chunk of Latin letters and stops is the word in small letters, then
    the stops; Arrow cuts the different chunks so. Their pieces are remembered in two generations: when the
    young one is full, it becomes the old one, and pieces still in use move over. Other vocabularies get whole texts. One encoder lives as long as
    its worker.
    """

    kept: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        # A task has one core; threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        blank, one, two, both = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in (" \n", "ab", "Cd", "ab\tCd"))
        self.chunked = not blank and both == one + two
        self.lowers = self._same("cd", "Cd") and self._same("é", "É")
        probes = ["a", "z", "river", "theses", "qqxzk"]
        self.bare = self.lowers and all(
            [x.id for x in self.tokenizer.model.tokenize(p)] == self.tokenizer.encode(p, add_special_tokens=False).ids for p in probes)
        spelled = {c: s for c, s in byte_letters(ord(LATIN_END)).items() if chr(c).isalpha() and chr(c).islower()}
        self.spelled = {c: s for c, s in spelled.items() if self.bare and self._spelled("a" + chr(c) + "b", "a" + s + "b")}
        self.words = re.compile("[" + "".join(map(chr, self.spelled)) + "]+") if self.spelled else re.compile("(?!)")
        self.stops = "".join(s for s in STOPS if self._ends(s))
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _same(self, a: str, b: str) -> bool:
        return self.tokenizer.encode(a, add_special_tokens=False).ids == self.tokenizer.encode(b, add_special_tokens=False).ids

    def _spelled(self, text: str, letters: str) -> bool:
        return [x.id for x in self.tokenizer.model.tokenize(letters)] == self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ends(self, stop: str) -> bool:
        """Whether a run of the stop, and one with other stops, is cut off the word before it."""
        whole, word, *runs = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in (
            f"ab{stop}{stop}", "ab", stop + stop, f"ab{stop}.!", f"{stop}.!"))
        return whole == word + runs[0] and runs[1] == word + runs[2]

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        """By the library; words of small Latin letters go to its model directly, as the rest of it would only spell them."""
        if not self.bare:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        plain, model, spelled = list(map(self.words.fullmatch, texts)), self.tokenizer.model.tokenize, self.spelled
        rest = [t for t, p in zip(texts, plain) if not p]
        others = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        return [array("I", [x.id for x in model(t if t.isascii() else t.translate(spelled))] if p else next(others).ids).tobytes()
                for t, p in zip(texts, plain)]

    def cut(self, chunks: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
        """The word in small letters and the stops after it; a chunk that is no such word stays whole."""
        if not self.lowers:
            return chunks, pa.array([""] * len(chunks), chunks.type)
        core = pc.utf8_rtrim(chunks, self.stops) if self.stops else chunks
        word = pc.match_substring_regex(core, LATIN_WORD)
        stops = pc.struct_field(pc.extract_regex(chunks, f"(?s)(?P<stops>[{re.escape(self.stops)}]*)\\z"), "stops") if self.stops else ""
        return pc.if_else(word, pc.utf8_lower(core), chunks), pc.if_else(word, stops, "")

    def learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces, from memory or from the library."""
        ids = list(map(self.young.get, pieces))
        unknown = [i for i, found in enumerate(ids) if found is None]
        missing = []
        for i in unknown:
            ids[i] = self.old.get(pieces[i])
            if ids[i] is None:
                missing.append(i)
        for i, found in zip(missing, self.encode([pieces[i] for i in missing])):
            ids[i] = found
        self.young.update((pieces[i], ids[i]) for i in unknown)
        return ids

    def __call__(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of every text. Chunks are numbered and put back together in Arrow, Python sees different ones only."""
        if not self.chunked:
            yield from (np.frombuffer(ids, dtype="<u4") for ids in self.encode(texts.to_pylist()))
            return
        if len(self.young) > WORDS:
            self.old, self.young = self.young, {"": b""}
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        cut = pc.split_pattern(texts, " ")
        chunks = cut.flatten().dictionary_encode()
        pieces = pa.concat_arrays(self.cut(chunks.dictionary)).dictionary_encode()
        ids = self.learn(pieces.dictionary.to_pylist())
        starts = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(i) // 4 for i in ids], out=starts[1:])
        known = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
        word, stops = pieces.indices.to_numpy().reshape(2, -1)
        spelled = known.take(pa.array(np.stack([word, stops], axis=1).ravel()))
        joined = pa.ListArray.from_arrays(spelled.offsets[::2], spelled.values).take(chunks.indices)
        ends = joined.offsets.to_numpy()[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        values = joined.values.to_numpy()
        yield from (values[low:high] for low, high in zip(ends[:-1], ends[1:]))


def some(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of texts of about ``CHARS`` bytes."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + n > CHARS:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


ENCODED = "doc_id long, task int, rest int, place long, full long, full_place long, ids binary"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int) -> DataFrame:
    """Per document its ids with the end id, what full stretches leave over, and its place in the task:
    among the documents with the same rest, and the full stretches before it."""
    schema = pa.schema([("doc_id", pa.int64()), ("task", pa.int32()), ("rest", pa.int32()), ("place", pa.int64()),
                        ("full", pa.int64()), ("full_place", pa.int64()), ("ids", pa.binary())])
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, places, before, encoder = TaskContext.get().partitionId(), Counter(), 0, None
        for batch in batches:
            encoder = encoder or Encoder.of(tokenizer)
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for low, high in some(texts):
                rows = []
                for doc_id, found in zip(names[low:high], encoder(texts[low:high])):
                    ids = found.tobytes() + end
                    full, rest = divmod(len(ids) // 4, length)
                    rows.append((doc_id, task, rest, places[rest], full, before, ids))
                    places[rest] += 1
                    before += full
                yield _batch(rows, schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(texts.mapInArrow(run, ENCODED), "packing-ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start (ids of the document before it), length, ids (little-endian
    32-bit), doc_tokens, sequence_id, offset (ids of the sequence before it).

    Every id of every whole text, and ``end_id`` after each, is in one piece. Sequences have ``length`` ids,
    the last few, at most one for each power of two below, have fewer, so that nothing is padded.
    Null texts are empty and have the end id only. Null and repeated ids are documents like any others. Ties
    of length are told apart by task and place in the task. No rows give no pieces. Other columns are ignored.

    The planner gets one count per length and returns intervals of ranks; both are bounded by ``length``.
    Ranks are offsets of tasks plus places within, so no window or task ever holds the documents of one
    length; documents are joined to their task's offsets.
    """
    encoded = encode_documents(docs, tokenizer, end_id, length)
    counts = materialize(encoded.groupBy("task", "rest").agg(F.count("*").alias("n"), F.sum("full").alias("full")), "packing-counts")
    sums = counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()
    n_full = sum(r.full for r in sums)
    placed = Placed(plan({r.rest: r.n for r in sums if r.rest}, length))

    earlier = lambda *by: Window.partitionBy(*by).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    rests = counts.select("task", "rest", F.coalesce(F.sum("n").over(earlier("rest")), F.lit(0)).alias("rank"))
    tasks = counts.groupBy("task").agg(F.sum("full").alias("full"))
    fulls = tasks.select("task", F.coalesce(F.sum("full").over(earlier()), F.lit(0)).alias("full_rank"))
    ranked = encoded.join(rests.join(fulls, "task"), ["task", "rest"]).select(
        "doc_id", "rest", "full", (F.col("rank") + F.col("place")).alias("rank"),
        (F.col("full_rank") + F.col("full_place")).alias("full_rank"), "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, rest, full, rank, full_rank, ids in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = len(ids) // 4
                found = [(i * length, length, full_rank + i, 0) for i in range(full)]
                found += [(full * length + s, size, n_full + sequence, at) for s, size, sequence, at in placed.pieces(rest, rank)]
                rows += [(doc_id, s, size, ids[4 * s:4 * (s + size)], tokens, sequence, at) for s, size, sequence, at in found]
            yield _batch(rows, schema)

    return ranked.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """Sequences as a trainer reads them: sequence_id, n_tokens, ids, and doc_id, start and length of the pieces
    in order. A sequence has a bounded number of ids, so its pieces fit into one row."""
    piece = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = pieces.repartition(parts(pieces.sparkSession), "sequence_id").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"))
    joined = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["ids"])), ""))
    return rows.select("sequence_id", F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
                       joined.alias("ids"), F.transform("pieces", lambda p: F.struct(p["doc_id"], p["start"], p["length"])).alias("pieces"))
