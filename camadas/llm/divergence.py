"""Source divergence audit with hash-consed segment trees over term ids.

Terms of a language are dealt into segments and numbered within them by falling frequency. The counts of a
source over a segment are a segment tree whose nodes are numbered by content: equal subtrees, of whatever
sources and places, are one node. Two trees are then walked together from their roots, and since a pair of
counts costs the same wherever it stands, every pair of nodes is priced once for each pair of sources.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from camadas.llm.common import parts
from camadas.session import materialize

LETTERS = re.compile(rb"[a-z\x80-\xff]+")
HELD_TERMS = 400_000
SEGMENT, BLOCK, PAIRS_AT_ONCE = 4096, 64, 256
COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
SMOOTHING = 5


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), summed within the task as far as memory allows.

    Bytes from x80 on are parts of characters beyond ASCII, all of which belong to terms. A row without a
    term says that its group occurs.
    """
    counts, docs, seen, held = defaultdict(Counter), defaultdict(Counter), set(), 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            size, within = len(found), docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(list(found), pa.binary()),
                 pa.array(list(found.values()), pa.int64()), pa.array([within[t] for t in found], pa.int64())], schema=COUNTED)
        counts.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            terms = LETTERS.findall(text.lower())
            group = counts[lang, source]
            held -= len(group)
            group.update(terms)
            held += len(group)
            docs[lang, source].update(set(terms))
            if (lang, source) not in seen:
                seen.add((lang, source))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((lang, source, None, 0, 0), COUNTED)],
                                                 schema=COUNTED)
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of whole texts; a null term names a group. Nulls are empty strings."""
    named = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    rows = named.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(_count, from_arrow_schema(COUNTED))
    return rows.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / total) by long division to base 1000: exact for totals up to 9 * 10^15."""
    rest, out = counts + SMOOTHING, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // totals, rest % totals
    return out + 1


def _share(n: str, total: str) -> Column:
    """``shares`` as a Column."""
    rest, out = f"({n} + {SMOOTHING})", "0L"
    for _ in range(3):
        out, rest = f"({out} * 1000 + ({rest} * 1000) div {total})", f"(({rest} * 1000) % {total})"
    return F.expr(f"1 + {out}")


class SegmentTrees:
    """The segment trees of several sources over the same terms, one number per distinct subtree.

    ``roots[i]`` is the root of source i; ``levels`` holds, from the leaves' parents up, the two child
    numbers of every node. Leaves are numbered by their count, places beyond the last term as one more.
    """

    def __init__(self, counts: np.ndarray) -> None:
        sources, width = counts.shape
        self.values, leaves = np.unique(counts, return_inverse=True)
        nodes = len(self.values) + 1
        full = 1 << max(width - 1, 0).bit_length()
        ids = np.full((sources, full), nodes - 1, dtype=np.int64)
        ids[:, :width] = leaves.reshape(counts.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while ids.shape[1] > 1:
            distinct, numbers = np.unique(ids[:, 0::2] * nodes + ids[:, 1::2], return_inverse=True)
            self.levels.append((distinct // nodes, distinct % nodes))
            ids, nodes = numbers.reshape(sources, -1), len(distinct)
        self.roots = ids[:, 0]

    def distances(self, totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sum of absolute differences of shares for each pair of sources (a[i], b[i])."""
        pair, x, y = np.arange(len(a)), self.roots[a], self.roots[b]
        joins = []
        for left, right in reversed(self.levels):
            bound = int(max(left.max(), right.max())) + 1
            code = np.concatenate([(pair * bound + side[x]) * bound + side[y] for side in (left, right)])
            distinct, numbers = np.unique(code, return_inverse=True)
            joins.append((numbers[:len(pair)], numbers[len(pair):]))
            pair, x, y = distinct // (bound * bound), distinct // bound % bound, distinct % bound
        real = x < len(self.values)
        price = np.zeros(len(pair), dtype=np.int64)
        ours, theirs = self.values[x[real]], self.values[y[real]]
        price[real] = np.abs(shares(ours, totals[a[pair[real]]]) - shares(theirs, totals[b[pair[real]]]))
        for first, second in reversed(joins):
            price = price[first] + price[second]
        return price


def _price(frame: pd.DataFrame) -> pd.DataFrame:
    """Partial distances of the pairs of one pair of blocks over one segment."""
    frame = frame.sort_values("source", ignore_index=True)
    sources, width = frame["source"].to_numpy(), int(frame["terms"].iat[0])
    first, second = np.nonzero(np.triu(np.ones((len(frame), len(frame)), dtype=bool), 1))
    low, high, block = frame["low"].iat[0], frame["high"].iat[0], frame["block"].to_numpy()
    wanted = (block[first] != block[second]) | (low == high)
    first, second = first[wanted], second[wanted]
    value = np.zeros(len(first), dtype=np.int64)
    if width and len(first):
        counts = np.zeros((len(frame), width), dtype=np.int64)
        for i, (places, n) in enumerate(zip(frame["places"], frame["counts"])):
            if places is not None and len(places):
                counts[i, np.asarray(places)] = np.asarray(n)
        trees, totals = SegmentTrees(counts), frame["total"].to_numpy()
        for at in range(0, len(first), PAIRS_AT_ONCE):
            cut = slice(at, at + PAIRS_AT_ONCE)
            value[cut] = trees.distances(totals, first[cut], second[cut])
    return pd.DataFrame({"lang": frame["lang"].iat[0], "a": sources[first], "b": sources[second], "value": value})


def kept_terms(counts: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """The terms in at least ``least_docs`` documents of their language, placed in segments, and per
    language V, the sum of counts and the number of segments (languages without terms included)."""
    totals = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = materialize(totals.where(F.col("docs") >= least_docs).drop("docs"), "audit-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_sum"))
    groups = counts.select("lang", "source").distinct()
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left").na.fill(0, ["v", "lang_sum"])
    segments = F.greatest(F.ceil(F.col("v") / SEGMENT), F.lit(1)).cast("int")
    langs = materialize(langs.withColumns({
        "segments": segments, "blocks": F.ceil(F.col("sources") / BLOCK).cast("int"),
        "lang_total": F.col("lang_sum") + SMOOTHING * F.col("v")}), "audit-languages")
    placed = kept.join(langs.select("lang", "segments"), "lang")
    placed = placed.withColumn("segment", F.pmod(F.xxhash64("term"), F.col("segments")).cast("int"))
    order = Window.partitionBy("lang", "segment").orderBy(F.col("lang_n").desc(), "term")
    return placed.select("lang", "term", "lang_n", "segment", (F.row_number().over(order) - 1).alias("place")), langs


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """How far sources of a language are apart, and which terms stand out in each.

    Rows (lang, source, part, item, value, rank). Part ``pair``: the distance to every other source of the
    language, largest first. Part ``term``: the terms whose share in the source exceeds that in the language,
    with the difference, at most ``top`` of them. Ties go to the item that sorts first by its UTF-8 bytes.
    A share is 1 + floor(10^9 * (count + 5) / (N + 5 V)).

    Null text, lang and source are empty strings. Terms are runs of letters A-Z, a-z and of characters beyond
    ASCII, of whole texts. A group without terms is a group; where a language keeps no term all its
    distances are 0. No rows give no rows. Other columns are ignored; ids are not read, so repeated rows
    count as often as they stand there.

    Rows grow with the square of a language's sources, which the result demands. A task holds at most two
    blocks of about ``BLOCK`` sources over about ``SEGMENT`` terms.
    """
    counts = materialize(term_counts(docs), "audit-counts")
    placed, langs = kept_terms(counts, least_docs)
    placed = materialize(placed, "audit-places")
    used = materialize(counts.where("term is not null").select("lang", "source", "term", "n").join(placed, ["lang", "term"]),
                       "audit-used")
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    groups = counts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang")
    groups = materialize(groups.select(
        "lang", "source", (F.coalesce("sum", F.lit(0)) + SMOOTHING * F.col("v")).alias("total"), "lang_total", "segments", "blocks",
        F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")), "audit-groups")

    widths = placed.groupBy("lang", "segment").agg(F.count("*").alias("terms"))
    vectors = used.groupBy("lang", "source", "segment").agg(F.collect_list(F.struct("place", "n")).alias("row"))
    vectors = vectors.select("lang", "source", "segment", F.col("row.place").alias("places"), F.col("row.n").alias("counts"))
    cells = groups.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)))
    cells = cells.join(vectors, ["lang", "source", "segment"], "left").join(widths, ["lang", "segment"], "left")
    cells = cells.na.fill(0, ["terms"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("lang", "source", "total", "segment", "terms", "block", "places", "counts",
                         F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    # A fixed number of partitions: the rows are few bytes, the work on them is not.
    cells = cells.repartition(parts(docs.sparkSession), "lang", "segment", "low", "high")
    partial = cells.groupBy("lang", "segment", "low", "high").applyInPandas(_price, "lang string, a string, b string, value long")
    pairs = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                    F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.withColumn("side", F.explode(sides)).select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")

    above = used.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    above = above.withColumn("value", _share("n", "total") - _share("lang_n", "lang_total")).where("value > 0 and n > 0")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
