"""Helpers the training-data operators share: reading, held-out folds, bounded models, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Labelled rows a classifier is fitted on at most. The bound is what allows their broadcast.
MAX_LABELS = 200_000
# Numbers in one row of a vector that is summed over tasks: rows of 32 KB.
SLICE = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, df: DataFrame) -> str:
    """The name, or a longer one where a column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """Rows with a key of their own: the id where it names one text, else a hash.

    Of several texts with one id the one whose hash is least keeps the id; the others, and rows without an id,
    get 61 bits of a hash of id and text above 2^62. Rows that agree in both have one key. Only ids are
    grouped; the join back meets the few ids that name several texts.
    """
    mark, shared, least = unused("mark", docs), unused("shared_id", docs), unused("least_mark", docs)
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()))
    several = marked.where("doc_id is not null").groupBy(F.col("doc_id").alias(shared)).agg(
        F.min(mark).alias(least), F.max(mark).alias("most")).where(F.col(least) != F.col("most")).drop("most")
    own = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col(mark)).bitwiseAND((1 << 61) - 1) + (1 << 62)
    key = F.when(F.col("doc_id").isNull() | (F.col(mark) != F.col(least)), own).otherwise(F.col("doc_id"))
    return marked.join(several, F.col("doc_id") == F.col(shared), "left").select(
        *(F.col(f"`{c}`") for c in docs.columns), key.alias(name))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(column: str, modulus: int, held: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == held, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, A-Z lower-cased; null has none.

    ``bytes.split`` cuts at exactly the characters x20 and x09-x0D, ``bytes.lower`` maps A-Z only.
    """
    return text.encode().lower().split() if text else []


def through(df: DataFrame, make: Callable[[pa.RecordBatch], dict], shape: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns as they are, so that ids with nulls stay exact, beside what ``make`` returns."""
    kept = T.StructType([df.schema[c] for c in keep])
    made = T.StructType.fromDDL(shape)
    schema = to_arrow_schema(T.StructType(kept.fields + made.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = make(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) if f.name in keep else pa.array(columns[f.name], f.type, from_pandas=True)
                     for f in schema], schema=schema)

    return df.mapInArrow(run, T.StructType(kept.fields + made.fields))


def label_sample(labels: DataFrame, column: str, held_out: Column, cap: int) -> DataFrame:
    """(doc_id, y) of labelled rows outside the held-out fold: all, or ``cap`` of them by hash order.

    The threshold on the hash keeps every row whose hash is small enough, so the sample is a function
    of the rows alone. A margin of one percent keeps the expected size below the cap.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out).select(
        "doc_id", F.col(column).cast("int").alias("y"))
    total = known.count()
    if total <= cap:
        return known
    limit = int(0.99 * cap / total * 2**31)
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < limit)


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are in the label sample; its size is bounded, so it may be broadcast."""
    return docs.join(F.broadcast(sample), "doc_id")


def in_slices(vector: np.ndarray) -> pd.DataFrame:
    """A vector as rows (slice, blob) of ``SLICE`` numbers each."""
    cuts = range(0, len(vector), SLICE)
    return pd.DataFrame({"slice": range(len(cuts)), "blob": [vector[at:at + SLICE].tobytes() for at in cuts]})


def summed(slices: DataFrame) -> np.ndarray | None:
    """The sum of float64 vectors of one length, given as rows of ``in_slices``.

    Equal slices meet in one task, so the driver receives a single vector at any input size.
    """
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for k, blob in zip(frame["slice"], frame["blob"]):
                row = np.frombuffer(blob)
                if k in total:
                    total[k] += row
                else:
                    total[k] = row.copy()
        if total:
            yield pd.DataFrame({"slice": list(total), "blob": [row.tobytes() for row in total.values()]})

    rows = slices.select("slice", "blob").repartition("slice").mapInPandas(add, "slice int, blob binary").collect()
    return np.frombuffer(b"".join(r.blob for r in sorted(rows, key=lambda r: r.slice))) if rows else None


def partial_sums(rows: DataFrame, measure: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray | None:
    """Sum ``measure`` over all batches of all partitions; None for no rows."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                part = np.asarray(measure(frame), dtype="float64").ravel()
                total = part if total is None else total + part
        if total is not None:
            yield in_slices(total)

    return summed(rows.mapInPandas(run, "slice int, blob binary"))


def isotonic(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (position, weight, sum of labels); knots for interpolation."""
    blocks: list[list[float]] = []
    for position, weight, total in sorted(bins):
        blocks.append([position, position, weight, total])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            low, high = blocks[-2], blocks.pop()
            low[1], low[2], low[3] = high[1], low[2] + high[2], low[3] + high[3]
    xs = [x for first, last, _, _ in blocks for x in (first, last)]
    ys = [(total + 0.5) / (weight + 1) for _, _, weight, total in blocks for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(np.array(ys)) if ys else np.array(ys)


def calibration(scored: DataFrame, low: float, high: float, bins: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic knots from (raw, y): at most ``bins`` counts reach the driver."""
    width = (high - low) / bins
    place = F.floor((F.least(F.greatest("raw", F.lit(low)), F.lit(high)) - low) / width)
    counts = scored.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    return isotonic([(low + (r.bin + 0.5) * width, r.n, r.s) for r in counts.collect()])


def calibrated(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray], empty: float) -> np.ndarray:
    xs, ys = knots
    return np.interp(raw, xs, ys) if len(xs) else np.full(len(raw), empty)


def byte_letters(last: int) -> dict[int, str]:
    """Code points below ``last`` as byte-level vocabularies spell them: one letter for every UTF-8 byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(last)}
