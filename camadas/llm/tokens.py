"""Token ids as Arrow files of fixed-size lists: equal-length sequences, read without copying.

A folder holds ``part-<n>.arrow`` (columns ``ids`` and ``mask``, one row per sequence of ``length``
ids, ``ROWS`` rows per record batch) and ``part-<n>.docs.arrow`` (doc_id, start within the part,
n_tokens). Every part fills its last sequence with id 0 under a false mask. All record batches of a
part but the last have the same number of rows, so sequence i is row ``i % ROWS`` of batch ``i // ROWS``.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from camadas.llm.common import byte_letters
from camadas.session import materialize, scratch_dir

LENGTH, ROWS = 1024, 512
CHUNKS, PIECES = 400_000, 700_000
STOPS = ".,;:!?#$%&*+-/=@^_~()[]{}<>|\\\"'"
LATIN_END = "\u0250"
# Fixed value: the public vocabulary's own cut into pre-tokens.
PRE_TOKEN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A space directly before other white space: only there do the chunks below differ from whole texts.
UNSAFE = re.compile(r" \s| $")


def pre_tokens(chunk: str) -> list[str]:
    """The cut of a chunk up to Latin letters, others stay whole; a word and the stops after it need no pattern."""
    if not chunk.isascii() and max(chunk) >= LATIN_END:
        return [chunk]
    core = chunk.rstrip(STOPS)
    if core[core[:1] == " ":].isalpha():
        return [core, chunk[len(core):]] if len(core) < len(chunk) else [core]
    return PRE_TOKEN.findall(chunk)


class Encoder:
    """Ids of whole texts with the tokenizers library, remembering the chunks and pieces it has seen.

    Byte-level pre-tokenisation always cuts before a single space that a non-space follows, so the
    ids of a text are those of its chunks " word" in a row, and those of a chunk are those of its
    pre-tokens. Texts with other runs of spaces or with the content of an added token, chunks beyond Latin
    letters, and vocabularies that do not cut there are encoded whole. ``of`` keeps one encoder for the life
    of a worker.
    """

    kept: dict[tuple, Encoder] = {}

    def __init__(self, path: str, dtype: str, chunked: bool, literal: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = () if literal else self.tokenizer.get_added_tokens_decoder().values()
        # Content matched after normalisation cannot be told from the raw text.
        unseen = self.tokenizer.normalizer is not None and any(t.normalized for t in added)
        self.dtype, self.chunked = dtype, chunked and not unseen
        self.added = re.compile("|".join(re.escape(t.content) for t in added if t.content) or r"(?!)")
        # Without a normaliser a pre-token is only spelled in letters for bytes before the model sees it.
        spelled = byte_letters(ord(LATIN_END)) if self.chunked and self.tokenizer.normalizer is None else {}
        alone = zip(spelled, self.whole(list(map(chr, spelled)))) if spelled else ()
        self.spelled = {c: spelled[c] for c, ids in alone if self.direct(spelled[c]) == ids}
        self.plain = re.compile("[" + "".join(re.escape(chr(c)) for c in self.spelled) + "]+") if self.spelled else re.compile("(?!)")
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @classmethod
    def of(cls, *key) -> Encoder:
        if key not in cls.kept:
            cls.kept[key] = cls(*key)
        return cls.kept[key]

    def whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 4096):
            found = self.tokenizer.encode_batch_fast(texts[at:at + 4096], add_special_tokens=False)
            out += [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]
        return out

    def direct(self, letters: str) -> bytes:
        """Ids of one pre-token, as byte-level vocabularies spell it."""
        return array("H" if self.dtype == "<u2" else "I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pre-tokens: by the model alone where that is all the library would do, else by the library."""
        plain, spelled = list(map(self.plain.fullmatch, pieces)), self.spelled
        others = iter(self.whole([p for p, known in zip(pieces, plain) if not known]))
        return [self.direct(p.translate(spelled)) if known else next(others) for p, known in zip(pieces, plain)]

    def learn(self, chunks: list[str]) -> None:
        if len(self.chunks) > CHUNKS:
            self.chunks.clear()
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        cut = {c: pre_tokens(c) for c in set(chunks).difference(self.chunks)}
        new = list({p for ps in cut.values() for p in ps}.difference(self.pieces))
        self.pieces.update(zip(new, self.encode(new)))
        for c, ps in cut.items():
            self.chunks[c] = self.pieces[ps[0]] if len(ps) == 1 else b"".join(map(self.pieces.__getitem__, ps))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if not self.chunked or UNSAFE.search(text) or self.added.search(text):
                yield self.whole([text])[0]
                continue
            head, *rest = text.split(" ")
            chunks = list(map(" ".__add__, rest))
            if head:
                chunks.insert(0, head)
            try:
                yield b"".join(map(self.chunks.__getitem__, chunks))
            except KeyError:
                self.learn(chunks)
                yield b"".join(map(self.chunks.__getitem__, chunks))


def vocabulary_dtype(path: str) -> str:
    """Two bytes per id where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"


def _stream(folder: str, name: str):
    """The file system, the final path and a path of this attempt for a file of the folder."""
    system, root = pafs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    return system, f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"


class SequenceWriter:
    """Appends ids and writes full record batches of sequences; renames the file when it is closed."""

    def __init__(self, folder: str, name: str, dtype: str, length: int) -> None:
        self.system, self.path, self.attempt = _stream(folder, name)
        self.dtype, self.length, self.size = np.dtype(dtype), length, length * ROWS
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)),
                                 ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.system.open_output_stream(self.attempt)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.size:
            flat = np.concatenate(self.pending)
            whole = len(flat) // self.size * self.size
            for at in range(0, whole, self.size):
                self._batch(flat[at:at + self.size], self.size)
            self.pending, self.held = [flat[whole:].copy()], len(flat) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        self.writer.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
            pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.zeros(-(-self.held // self.length) * self.length, dtype=self.dtype)
            ids[:self.held] = np.concatenate(self.pending)
            self._batch(ids, self.held)
        self.writer.close()
        self.sink.close()
        self.system.move(self.attempt, self.path)


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, length: int = LENGTH,
                    chunked: bool = True, literal: bool = True) -> DataFrame:
    """Encode every text in ascending id order into ``folder`` (a URI all executors share).

    ``literal`` takes the content of special tokens within a text as plain text; without it the ids are those
    of the library's own call. Returns one row per part: part, n_tokens. The rows are range-partitioned by id, each task writes
    its own part, and a repeated task replaces its part by the same bytes. Null and empty texts have
    the end id only; null ids come first; repeated ids follow one another by text; no rows write no
    part; other columns are ignored.
    """
    dtype, spark = vocabulary_dtype(tokenizer), docs.sparkSession
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange(_parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, sequences, at = TaskContext.get().partitionId(), None, None, 0
        ids_of, starts, counts = [], [], []
        for batch in batches:
            if encoder is None and batch.num_rows:
                encoder = Encoder.of(tokenizer, dtype, chunked, literal)
                sequences = SequenceWriter(folder, f"part-{part:06d}.arrow", dtype, length)
            for ids in encoder(batch.column("text").to_pylist()) if encoder else ():
                row = np.append(np.frombuffer(ids, dtype=dtype), np.array([end_id], dtype=dtype))
                sequences.add(row)
                starts.append(at)
                counts.append(len(row))
                at += len(row)
            ids_of.append(batch.column("doc_id"))
        if sequences is not None:
            sequences.close()
            _write_index(folder, part, pa.chunked_array(ids_of, pa.int64()), starts, counts)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n_tokens": pa.array([at], pa.int64())})

    return materialize(ordered.mapInArrow(run, "part long, n_tokens long"), "token-parts")


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write_index(folder: str, part: int, docs: pa.ChunkedArray, starts: list, counts: list) -> None:
    index = pa.table({"doc_id": docs, "start": pa.array(starts, pa.int64()),
                      "n_tokens": pa.array(counts, pa.int64())})
    system, path, attempt = _stream(folder, f"part-{part:06d}.docs.arrow")
    with system.open_output_stream(attempt) as sink, pa.ipc.new_file(sink, index.schema) as writer:
        writer.write_table(index)
    system.move(attempt, path)


def open_part(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """A reader over a file of the folder; memory-mapped where the file system is local."""
    system, root = pafs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem)
                            else system.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of sequence ``i``; the ids are a view of the file's own buffer."""
    batch, row = reader.get_batch(i // ROWS), i % ROWS
    length = batch.schema.field("ids").type.list_size
    flat = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
    return flat[row * length:(row + 1) * length], batch.column("mask").flatten().slice(row * length, length)


def _part_ids(reader: pa.ipc.RecordBatchFileReader) -> Iterator[np.ndarray]:
    """The real ids of a part, batch by batch, without the filling."""
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        flat = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        yield flat[:batch.column("mask").flatten().true_count]


def read_documents(parts: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start over all parts, n_tokens, ids_crc32.

    The running sum over parts has one row per part. Each part is read by one task, batch by batch.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = open_part(folder, f"part-{row['part']:06d}.docs.arrow").read_all()
                counts = index.column("n_tokens").to_numpy()
                sums = _checksums(_part_ids(open_part(folder, f"part-{row['part']:06d}.arrow")), counts)
                found = pa.table({
                    "doc_id": index.column("doc_id"), "start": index.column("start").to_numpy() + row["base"],
                    "n_tokens": counts, "ids_crc32": pa.array(sums, pa.int64())})
                yield from found.combine_chunks().to_batches()

    return based.repartition(_parts(parts.sparkSession), "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _checksums(batches: Iterator[np.ndarray], counts: np.ndarray) -> list[int]:
    held, out = np.zeros(0, "<u4"), []
    for count in counts:
        pieces = [held]
        have = len(held)
        while have < count:
            pieces.append(next(batches))
            have += len(pieces[-1])
        flat = np.concatenate(pieces) if len(pieces) > 1 else held
        out.append(zlib.crc32(flat[:count].astype("<u4").tobytes()))
        held = flat[count:]
    return out


def encode(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH) -> DataFrame:
    """Write the library's ids of the documents under the shared scratch folder and read their digests back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_documents(write_sequences(docs, folder, tokenizer, end_id, length, literal=False), folder)
