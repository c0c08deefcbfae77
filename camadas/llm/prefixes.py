"""Conversation prefix trie by truncation peeling.

A rebuilt conversation is a path: per turn 16 bytes of a SHA-256 over role and text and 4 bytes of the
text's length. Paths are dealt to tasks by range, so that a prefix shared by any number of conversations
is spread over as many tasks as its conversations fill. Each task peels its run from the deepest level:
conversations that end at a depth merge with the nodes that survive from below, every node of the level is
finished, and stripping its last turn regroups the survivors one level up. Only nodes on the first and the
last path of a task can have members elsewhere. They stay open, and the open chains of all tasks are peeled
again by fewer tasks, until one task closes the root.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from camadas.llm.common import parts
from camadas.session import materialize

TURN = 20
TURNS_A_TASK, FEWER = 200_000, 32
ID_BYTES = 16_384
NO_ENDS = hashlib.sha256(b"").hexdigest()

LONGS = pa.list_(pa.int64())
RUN = pa.schema([("path", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("ends", pa.string())])
CHAIN = pa.schema([("path", pa.binary()), ("low", pa.int32()), ("n", LONGS), ("first", LONGS), ("children", LONGS),
                   ("leaves", LONGS), ("saved", LONGS), ("ends", pa.list_(pa.string()))])
NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("key", pa.string()),
                  ("parent_key", pa.string()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                  ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_code(role: str = "role", text: str = "text") -> Column:
    """A turn as 40 hex digits: what it says, and how many bytes its text has. Nulls count as empty."""
    who, what = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    said = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256)
    return F.concat(F.substring(said, 1, 32), F.lpad(F.hex(F.octet_length(what)), 8, "0"))


def rebuilt(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, path): the first h turns of the family's first conversation, then the own turns after h.

    h is crc32 of the id as text modulo ``heads``; the family's first conversation is ``c - c % family``.
    One shuffle: families are dealt together, a conversation is sorted within its row, and at most
    ``heads - 1`` turns of the first one are handed on.
    """
    base = F.col("conv_id") - F.col("conv_id") % family
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", base.alias("base"), F.struct("turn", turn_code().alias("code")).alias("said"))
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    own = own.select("base", "conv_id", F.transform("said", lambda t: t["code"]).alias("own"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads - 1))).over(Window.partitionBy("base"))
    cut = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    none = F.array().cast("array<string>")
    path = F.concat(F.slice(F.coalesce("head", none), 1, F.col("h")),
                    F.when(F.size("own") > F.col("h"), F.slice("own", F.col("h") + 1, F.size("own"))).otherwise(none))
    return own.withColumns({"head": head, "h": cut}).select("conv_id", F.unhex(F.array_join(path, "")).alias("path"))


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in the order of (path, id) to one row per path. A path that may go on in another task, or whose
    ids fill more than a chunk, comes as chunks of joined ids instead of a digest."""
    path, ids, low, size, chunked, out = None, [], None, 0, True, []

    def close(whole: bool) -> None:
        joined = ",".join(map(str, ids)).encode()
        out.append((path, low, len(ids), None, hashlib.sha256(joined).hexdigest()) if whole
                   else (path, low, len(ids), joined, None))

    for batch in batches:
        for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != path:
                if ids:
                    close(not chunked)
                chunked, path, ids, size = path is None, p, [], 0
            elif size > ID_BYTES:
                close(False)
                chunked, ids, size = True, [], 0
            if not ids:
                low = c
            ids.append(c)
            size += 21
        yield _as_batch(out, RUN)
        out = []
    if ids:
        close(False)
        yield _as_batch(out, RUN)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in the order of (path, id) to one digest per path, holding one chunk at a time."""
    path, low, n, sha, out = None, None, 0, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["path"] != path:
                if path is not None:
                    out.append((path, low, n, None, sha.hexdigest()))
                path, low, n, sha = row["path"], row["conv_id"], 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(row["ids"])
            n += row["n"]
        yield _as_batch(out, RUN)
        out = []
    if path is not None:
        yield _as_batch([(path, low, n, None, sha.hexdigest())], RUN)


def endings(paths: DataFrame) -> DataFrame:
    """(path, conv_id, n, ends): conversations that are the same sequence as one row with their digest.

    Copies are dealt by (path, id), so a large group fills many tasks. A digest reads the ids one after
    another by definition; for a large group one task reads its joined chunks, never its rows.
    """
    n = parts(paths.sparkSession)
    ordered = paths.select("path", "conv_id").repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    runs = materialize(ordered.mapInArrow(_runs, from_arrow_schema(RUN)), "conversation-runs")
    chunks = runs.where("ids is not null").repartition(n, "path").sortWithinPartitions("path", "conv_id")
    return runs.where("ids is null").unionByName(chunks.mapInArrow(_joined, from_arrow_schema(RUN))).drop("ids")


class Node:
    """A prefix while its level is peeled: what ended there and what its finished children add."""

    __slots__ = ("n", "first", "children", "leaves", "saved", "ends", "below")

    def __init__(self) -> None:
        self.n = self.children = self.leaves = self.saved = 0
        self.first = self.ends = None
        self.below: list[tuple] = []

    def add(self, n: int, first: int | None, children: int, leaves: int, saved: int, ends: str | None = None) -> None:
        self.n, self.children = self.n + n, self.children + children
        self.leaves, self.saved = self.leaves + leaves, self.saved + saved
        if first is not None:
            self.first = first if self.first is None else min(first, self.first)
        self.ends = self.ends or ends


def _key(path: bytes) -> str:
    return hashlib.sha256(path).hexdigest()


def peel(chains: list[dict], closing: bool, keyed: bool) -> Iterator[tuple[tuple | None, tuple | None]]:
    """Finished nodes and open chains, as (node, None) and (None, chain), from the deepest level up.

    ``closing``: the chains are all there are, so that no node stays open. ``keyed``: nodes carry the
    digest of their path, for children that were finished before them.
    """
    if not chains:
        return
    ends = [] if closing else sorted({f(c["path"] for c in chains) for f in (min, max)})
    arriving = defaultdict(list)
    for chain in chains:
        arriving[len(chain["path"]) // TURN].append(chain)
    held: list[dict] = []
    level: dict[bytes, Node] = {}
    kept: dict[bytes, Node] = {}
    for depth in range(max(arriving), -1, -1):
        held = [c for c in held + arriving.pop(depth, []) if c["low"] <= depth]
        for c in held:
            at = depth - c["low"]
            level.setdefault(c["path"][:depth * TURN], Node()).add(
                *(c[k][at] for k in ("n", "first", "children", "leaves", "saved", "ends")))
        above: dict[bytes, Node] = {}
        for path, node in level.items():
            opened = any(len(e) >= len(path) and e.startswith(path) for e in ends)
            for row in node.below:
                yield (*row[:2], None if opened else node.first, row[3], _key(path) if opened else None, *row[5:]), None
            node.below = []
            if opened:
                kept[path] = node
                continue
            node.leaves = node.leaves if node.children else 1
            node.saved += (node.n - 1) * int.from_bytes(path[-4:], "big")
            row = (node.first, depth, None, _key(path) if keyed else None, None, node.n, node.children, node.leaves,
                   node.saved, node.ends or NO_ENDS)
            if depth == 0:
                yield row, None
            else:
                parent = above.setdefault(path[:-TURN], Node())
                parent.add(node.n, node.first, 1, node.leaves, node.saved)
                parent.below.append(row)
        level = above
    low = 0
    for path in ends:
        nodes = [kept.get(path[:d * TURN], Node()) for d in range(low, len(path) // TURN + 1)]
        if nodes:
            yield None, (path, low, *([getattr(x, k) for x in nodes]
                                      for k in ("n", "first", "children", "leaves", "saved", "ends")))
        low = _shared(path, ends[-1]) + 1


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    n = min(len(a), len(b)) // TURN
    return next((d for d in range(n) if a[d * TURN:(d + 1) * TURN] != b[d * TURN:(d + 1) * TURN]), n)


def _round(chains: DataFrame, tasks: int, keyed: bool) -> DataFrame:
    dealt = chains.repartitionByRange(tasks, "path") if tasks > 1 else chains.repartition(1)
    both = pa.schema([*NODE, *CHAIN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains, out = [row for batch in batches for row in batch.to_pylist()], []
        for node, chain in peel(chains, tasks == 1, keyed):
            out.append((*(node or (None,) * len(NODE)), *(chain or (None,) * len(CHAIN))))
            if len(out) == 10_000:
                yield _as_batch(out, both)
                out = []
        yield _as_batch(out, both)

    return materialize(dealt.mapInArrow(run, from_arrow_schema(both)), "prefix-level")


def prefix_trie(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, the empty one included.

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's; null at the root), n_convs,
    n_children, n_leaves and saved_tokens (over the subtree), ends_sha256 (ids of the members that end there,
    ascending, joined by commas).

    Turns are ordered by turn, null first; equal turns by the SHA-256 of role and text, so that repeated
    rows are repeated turns and their order does not matter. Null role and text are empty. Rows without a
    conv_id belong to no conversation and take no part. A conversation left without turns is a member of
    the root. No conversations give no rows, not even a root. Other columns are ignored.

    Texts are not moved, 20 bytes a turn stand for them. The turns of one conversation form one
    row; everything else, copies and shared prefixes of any number included, is dealt by range.
    """
    spark = conversations.sparkSession
    ended = materialize(endings(rebuilt(conversations, family, heads)), "conversation-ends")
    turns = ended.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    depth = F.floor(F.octet_length("path") / TURN).cast("int")
    zero = F.array(F.lit(0).cast("long"))
    chains = ended.select("path", depth.alias("low"), F.array("n").alias("n"), F.array("conv_id").alias("first"),
                          *(zero.alias(c) for c in ("children", "leaves", "saved")), F.array("ends").alias("ends"))
    tasks = max(parts(spark), math.ceil(turns / TURN / TURNS_A_TASK))
    nodes, keyed = [], False
    while True:
        done = _round(chains, tasks, keyed)
        nodes.append(done.where("depth is not null").select(*NODE.names))
        if tasks == 1:
            break
        chains, tasks, keyed = done.where("path is not null").select(*CHAIN.names), math.ceil(tasks / FEWER), True
    found = nodes[0]
    for more in nodes[1:]:
        found = found.unionByName(more)
    closed_later = found.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of"))
    known = found.where("parent_key is null")
    late = found.where("parent_key is not null").join(closed_later, "parent_key").withColumn("parent_conv_id", F.col("of"))
    return known.select(*COLUMNS).unionByName(late.select(*COLUMNS))
