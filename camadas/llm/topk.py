"""Exact top-k inner products on a bit-sliced index.

A block of vectors keeps, for every dimension, one bitmap per bit of the quantised component. A query's
score is added up in bitmap arithmetic: each component's slices, shifted by the set bits of the query's
component, go through a ripple-carry adder, giving the sums' own slices. The k-th largest sum is read off
from the most significant slice downward. Quantising bounds the error, so the rows within that bound of
the k-th sum are scored exactly, and no other row can be among the first k.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERIES = 8192, 1024
SCALE, SLICES = 1024, 6
SCHEMA = "query_id long, vec_id long, score long"


class BitSlices:
    """The slices of a block: ``bits[d, s]`` marks the rows whose quantised component d has bit s."""

    def __init__(self, values: np.ndarray, slices: int = SLICES) -> None:
        self.values = values.astype("i8")
        self.low = self.values.min(axis=0)
        spread = int((self.values.max(axis=0) - self.low).max())
        self.drop = max(0, spread.bit_length() - slices)
        quantised = (self.values - self.low) >> self.drop
        self.rows, self.words = len(values), -(-len(values) // 64)
        self.count = min(slices, max(1, spread.bit_length()))
        self.bits = np.zeros((values.shape[1], self.count, self.words), "u8")
        for s in range(self.count):
            self.bits[:, s] = self._pack(((quantised >> s) & 1).T.astype("u1"))
        self.every = self._pack(np.ones((1, self.rows), "u1"))[0]

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(flags), self.words * 64), "u1")
        padded[:, :flags.shape[1]] = flags
        return np.packbits(padded, axis=1, bitorder="little").view("u8")

    def sums(self, queries: np.ndarray) -> list[np.ndarray]:
        """Slices of sum over d of |q_d| * (y_d, or its complement for negative q_d), one row per query.

        The complement turns the subtraction into an addition that differs by a constant per query.
        """
        size, negative = np.abs(queries), np.where(queries < 0, ~np.uint64(0), np.uint64(0))
        total: list[np.ndarray] = []
        for d in range(queries.shape[1]):
            for t in range(int(size[:, d].max(initial=0)).bit_length()):
                chosen = np.where((size[:, d] >> t) & 1 > 0, ~np.uint64(0), np.uint64(0))[:, None]
                if chosen.any():
                    operand = [(self.bits[d, s] ^ negative[:, d, None]) & chosen for s in range(self.count)]
                    self._add(total, operand, t)
        return total

    def _add(self, total: list[np.ndarray], operand: list[np.ndarray], shift: int) -> None:
        carry = None
        at = shift
        for piece in operand:
            while len(total) <= at:
                total.append(np.zeros_like(piece))
            old = total[at]
            half = old ^ piece
            if carry is None:
                total[at], carry = half, old & piece
            else:
                total[at], carry = half ^ carry, (old & piece) | (carry & half)
            at += 1
        while carry is not None and carry.any():
            if len(total) <= at:
                total.append(np.zeros_like(carry))
            total[at], carry = total[at] ^ carry, total[at] & carry
            at += 1

    def kth(self, total: list[np.ndarray], k: int) -> list[int]:
        """The k-th largest sum of every query: one decision per slice, the most significant first."""
        n = len(total[0])
        above, open_ = np.zeros((n, self.words), "u8"), np.repeat(self.every[None], n, 0)
        value = [0] * n
        for s in range(len(total) - 1, -1, -1):
            candidate = above | (open_ & total[s])
            few = np.bitwise_count(candidate).sum(axis=1) < k
            above = np.where(few[:, None], candidate, above)
            open_ = np.where(few[:, None], open_ & ~total[s], open_ & total[s])
            for j in np.flatnonzero(~few):
                value[j] |= 1 << s
        return value

    def at_least(self, total: list[np.ndarray], bounds: list[int]) -> np.ndarray:
        """Bitmaps of the rows whose sum reaches the query's bound, again from the top slice down."""
        n = len(total[0])
        above, equal = np.zeros((n, self.words), "u8"), np.repeat(self.every[None], n, 0)
        for s in range(len(total) - 1, -1, -1):
            ones = np.array([(b >> s) & 1 for b in bounds], bool)[:, None]
            above |= np.where(ones, np.uint64(0), equal & total[s])
            equal = np.where(ones, equal & total[s], equal & ~total[s])
        return above | equal

    def top(self, queries: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, id, score) of the k best rows of the block for every query, itself excluded."""
        total = self.sums(queries)
        # the rows of a query's own id may all be among the best
        own, times = np.unique(ids[np.isin(ids, query_ids)], return_counts=True)
        reach = min(k + (int(times.max()) if len(own) else 0), self.rows)
        if total:
            # a dropped remainder is below 2^drop in every component
            slack = np.abs(queries).sum(axis=1) * ((1 << self.drop) - 1)
            worst = [max(0, v - -(-int(e) // (1 << self.drop))) for v, e in zip(self.kth(total, reach), slack)]
            worst = [min(w, (1 << len(total)) - 1) for w in worst]
            hits = np.unpackbits(self.at_least(total, worst).view("u1"), axis=1, bitorder="little")[:, :self.rows]
        else:
            hits = np.ones((len(queries), self.rows), "u1")
        out = []
        for j, query in enumerate(query_ids):
            rows = np.flatnonzero(hits[j])
            rows = rows[ids[rows] != query]
            scores = self.values[rows] @ queries[j]
            best = np.lexsort((ids[rows], -scores))[:k]
            out += [(int(query), int(ids[rows[b]]), int(scores[b])) for b in best]
        return out


def integers(vectors: Column) -> Column:
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): integer vectors without null or non-finite components."""
    x = F.col(vector_column)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0) & fine)
    return kept.select(F.col(id_column).alias("vec_id"), integers(x).alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """Per query its ``k`` best rows: query_id, rank, vec_id, score; ties go to the smaller id.

    Rows are hashed into blocks of about ``BLOCK``, queries into blocks of about ``QUERIES``; every index
    block meets every query block once in its own task, so no task holds more than a block of each, and
    k rows per query and block go on to the final ranking.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do null ids.
    Vectors of another length than a query's are compared with queries of their length only. A repeated id
    counts as several candidates; as a query equal rows of an id ask once, and the best rows of different ones are merged. No rows give no rows; other columns are ignored.
    """
    index = usable(vectors, id_column, vector_column)
    queries = index.where(is_query).dropDuplicates(["vec_id", "v"])
    n_blocks, n_queries = max(1, -(-index.count() // BLOCK)), max(1, -(-queries.count() // QUERIES))
    mixed = F.xxhash64("vec_id")
    width = F.size("v").alias("width")
    left = index.select("vec_id", "v", width, F.pmod(mixed, F.lit(n_blocks)).alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("lot"))
    right = queries.select("vec_id", "v", width, F.pmod(mixed, F.lit(n_queries)).cast("int").alias("lot"),
                           F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")).alias("block"))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="i8") for c in ("query_id", "vec_id", "score")})
        found = BitSlices(np.stack(rows["v"].to_numpy())).top(
            np.stack(asked["v"].to_numpy()).astype("i8"), rows["vec_id"].to_numpy(), asked["vec_id"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    by = ["block", "lot", "width"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
