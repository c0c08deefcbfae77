"""MinHash near-duplicates: banded candidates, odd sketches to judge them, full sets to confirm them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camadas.llm.common import through, words_of
from camadas.session import materialize

ROWS, BANDS = 5, 30
SKETCH_WORDS = 8
# Buckets up to this size list their open pairs; larger ones go on to the prefix join.
SMALL_BUCKET = 32
STAR_ROUNDS, PROGRESS = 2, 0.8
CACHE = 500_000


class Codes(dict):
    """64-bit codes of words, remembering the words seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


def shingle_hashes(words: list[bytes], size: int, known: Codes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``size`` are one shingle."""
    if not words:
        return np.zeros(0, "u8")
    codes = np.fromiter(map(known.__getitem__, words), "u8", len(words))
    mixed = np.full(max(1, len(codes) - size + 1), len(codes) if len(codes) < size else size, dtype="u8")
    for k in range(min(size, len(codes))):
        mixed = (mixed ^ codes[k:k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


class Signer:
    """MinHash values of a shingle set, its band keys and its odd sketch."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        k = ROWS * BANDS
        self.multiply = (rng.integers(0, 2**31, k, dtype="u4") * np.uint32(2) + np.uint32(1))[:, None]
        self.add = rng.integers(0, 2**32, k, dtype="u4")[:, None]
        self.places = np.arange(k, dtype="u8")

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        folded = (shingles ^ (shingles >> np.uint64(32))).astype("u4")
        least = np.full(len(self.multiply), 2**32 - 1, dtype="u4")
        for at in range(0, len(folded), 4096):
            hashed = self.multiply * folded[None, at:at + 4096] + self.add
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x2C1B3C6D)
            np.minimum(least, hashed.min(axis=1), out=least)
        return least

    def bands(self, least: np.ndarray) -> list[bytes]:
        rows = least.reshape(BANDS, ROWS)
        return [xxhash.xxh3_64_digest(rows[b].tobytes(), seed=b) for b in range(BANDS)]

    def sketch(self, least: np.ndarray) -> np.ndarray:
        """Each sample (place, minimum) flips one bit: a bit is the parity of the samples it got."""
        bits = SKETCH_WORDS * 64
        mixed = (least.astype("u8") + self.places * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        flips = np.bincount((mixed >> np.uint64(32)) % np.uint64(bits), minlength=bits) & 1
        return np.packbits(flips.astype("u1"), bitorder="little").view("<i8")


def most_differing_bits(threshold: float, deviations: float = 5.0) -> int:
    """How many bits two odd sketches at the threshold differ in at most, but for five deviations.

    k samples of sets with similarity J disagree in k(1-J) places on average, which toggles
    m = 2k(1-J) bits; a bit of the XOR is set with probability (1 - exp(-2m/n)) / 2. Both the number of
    disagreements and the occupancy vary.
    """
    k, n, j = ROWS * BANDS, SKETCH_WORDS * 64, threshold
    p = (1 - np.exp(-4 * k * (1 - j) / n)) / 2
    slope = n * np.exp(-4 * k * (1 - j) / n) * 2 * k / n
    spread = np.sqrt(n * p * (1 - p) + slope**2 * j * (1 - j) / k)
    return int(np.ceil(n * p + deviations * spread))


def sign(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sketch): a class of equal sets has one set_key."""
    signer = Signer()

    def make(batch: pa.RecordBatch) -> dict:
        known = Codes()
        out: dict = {"n_shingles": [], "set_key": [], "bands": [], "sketch": []}
        for text in batch.column("text").to_pylist():
            shingles = shingle_hashes(words_of(text), size, known)
            out["n_shingles"].append(len(shingles))
            if len(shingles):
                least = signer.minima(shingles)
                out["set_key"].append(xxhash.xxh3_128_digest(shingles.tobytes()))
                out["bands"].append(np.frombuffer(b"".join(signer.bands(least)), "<i8"))
                out["sketch"].append(signer.sketch(least))
            else:
                for name in ("set_key", "bands", "sketch"):
                    out[name].append(None)
        return out

    return through(docs.select("doc_id", "text"), make,
                   "n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) of the nodes in edges: the smallest node reachable over undirected edges (a, b).

    Every round each root hangs itself below the smallest root next to it, then chains are halved until
    every node points to a root; edges inside a component are dropped. Only tables are written.
    """
    open_edges = materialize(edges.select("a", "b").where("a != b").distinct(), label)
    parent = None
    while not open_edges.isEmpty():
        both = open_edges.union(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("b", "node").alias("up")), label)
        while True:
            higher = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = materialize(hooks.join(higher, "up").select(
                "node", F.col("top").alias("up"), (F.col("up") != F.col("top")).alias("moved")), label)
            hooks = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        if parent is None:
            parent = hooks
        else:
            top = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = materialize(parent.join(top, "up", "left").select("node", F.coalesce("top", "up").alias("up")), label)
        open_edges = materialize(
            open_edges.join(hooks.toDF("a", "ra"), "a").join(hooks.toDF("b", "rb"), "b")
            .where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), label)
    if parent is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where(F.lit(False))
    return parent.select("node", F.col("up").alias("root"))


class Linker:
    """Finds the links between class representatives, and merges them into components.

    A bucket is a set of representatives that share a band. In a star round the bucket's centre, chosen
    by a hash, is compared with every member outside its component and then leaves the bucket: all its
    pairs are settled. A bucket is done when its members are in one component. Rounds go on while they
    settle a fifth of what is open. What is left is settled pair by pair: in small buckets directly, in large ones by joining prefixes of
    the rarest shingles, which meets every pair at the threshold. No bucket is ever expanded into all
    its pairs.
    """

    def __init__(self, reps: DataFrame, texts: DataFrame, same: DataFrame, size: int, threshold: float) -> None:
        self.reps, self.texts, self.size, self.threshold = reps, texts, size, threshold
        self.links = same
        self.labels = self.merged()
        self.sets: DataFrame | None = None

    def merged(self) -> DataFrame:
        return materialize(components(self.links, "neardup-roots"), "neardup-labels")

    def rooted(self, members: DataFrame) -> DataFrame:
        return members.join(self.labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "root", F.coalesce("root", "rep"))

    def settle(self, pairs: DataFrame) -> None:
        """Confirm candidate pairs (a, b) and merge the components of those that hold."""
        facts = self.reps.select("rep", "n_shingles", "sketch")
        left, right = (facts.toDF(x, f"n_{x}", f"s_{x}") for x in "ab")
        differing = F.bit_count(F.col("s_a")[0].bitwiseXOR(F.col("s_b")[0]))
        for i in range(1, SKETCH_WORDS):
            differing += F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i]))
        likely = pairs.distinct().join(left, "a").join(right, "b").where(
            (differing <= most_differing_bits(self.threshold))
            & (F.least("n_a", "n_b") >= self.threshold * F.greatest("n_a", "n_b") - 1e-6)).select("a", "b")
        likely = materialize(likely.distinct(), "neardup-likely")
        found = materialize(confirm(likely, self.sets, self.threshold), "neardup-links")
        self.links = self.links.unionByName(found)
        self.labels = self.merged()

    def run(self) -> None:
        buckets = self.reps.select("rep", F.explode("bands").alias("key"))
        crowded = buckets.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"))
        buckets = materialize(buckets.join(crowded.where("centre != last").drop("last"), "key"), "neardup-buckets")
        if buckets.isEmpty():
            return
        wanted = self.texts.join(buckets.select("rep").distinct(), "rep", "left_semi")
        self.sets = materialize(shingle_sets(wanted, self.size), "neardup-sets")
        pairs = buckets.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
        turn, left, going = 0, buckets.count(), True
        while going:
            turn += 1
            self.settle(pairs.where("a != b"))
            buckets = self.open_buckets(buckets.where("rep != centre"), turn)
            before, left = left, buckets.count()
            if not left:
                return
            pairs = buckets.where("root != centre_root").select(
                F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
            going = turn < STAR_ROUNDS or left < PROGRESS * before
        self.settle(self.open_pairs(buckets))

    def open_buckets(self, buckets: DataFrame, turn: int) -> DataFrame:
        """Members of buckets that still hold several components, with a new centre each.

        Members of the centre's own component need no comparison with it but stay for the next turn.
        """
        rooted = self.rooted(buckets.select("key", "rep"))
        pick = F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), F.col("rep").alias("centre"), F.col("root").alias("centre_root"))
        state = rooted.groupBy("key").agg(
            F.min(pick).alias("c"), F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
        state = state.where("low != high").select("key", "size", "c.centre", "c.centre_root")
        return materialize(rooted.join(state, "key"), "neardup-open")

    def open_pairs(self, members: DataFrame) -> DataFrame:
        small = members.where(F.col("size") <= SMALL_BUCKET)
        left, right = (small.select("key", F.col("rep").alias(x), F.col("root").alias(f"r_{x}")) for x in "ab")
        pairs = left.join(right, "key").where("a < b and r_a != r_b").select("a", "b")
        large = members.where(F.col("size") > SMALL_BUCKET).select("rep", "root").distinct()
        return pairs.unionByName(self.prefix_pairs(materialize(large, "neardup-large")))

    def prefix_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of different components that share one of their rarest shingles.

        Sets are put in a common order by rising frequency. With sizes n_a >= n_b, similarity t needs an
        overlap of t / (1 + t) * (n_a + n_b), so the sets share a shingle among the first
        n_a - ceil(t * n_a) + 1 of the larger and n_b - ceil(2t / (1 + t) * n_b) + 1 of the smaller. Their
        first common one is at places that leave room for the rest of the overlap; pairs without room,
        and groups of texts that only share their frequent parts, are not listed.
        """
        sets = self.sets.join(members.select("rep"), "rep", "left_semi")
        spread = materialize(sets.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), "neardup-spread")
        common = spread.groupBy("shingle").agg(F.count("*").alias("seen")).where("seen > 1")
        ranked = spread.join(common, "shingle", "left").groupBy("rep", "n").agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("seen", F.lit(1)).alias("seen"), "shingle"))).alias("all"))
        t = self.threshold

        def prefix(share: float):
            return (F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1).cast("int")

        first = ranked.select("rep", "n", prefix(2 * t / (1 + t)).alias("short"),
                              F.posexplode(F.slice("all", F.lit(1), prefix(t))).alias("at", "s")).where("s.seen > 1")
        first = materialize(first.select("rep", "n", "at", (F.col("at") < F.col("short")).alias("early"),
                                         F.col("s.shingle").alias("shingle")).join(members, "rep"), "neardup-prefix")
        larger, smaller = (first.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "root", "n", "at", "early")]) for x in "ab")
        bigger = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("rep_a") > F.col("rep_b")))
        room = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
        enough = room >= t / (1 + t) * (F.col("n_a") + F.col("n_b")) - 1e-6
        return larger.join(smaller.where("early_b"), "shingle").where(
            bigger & enough & (F.col("root_a") != F.col("root_b"))).select(
            F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    def make(batch: pa.RecordBatch) -> dict:
        known = Codes()
        return {"shingles": [shingle_hashes(words_of(t), size, known).view("i8") for t in batch.column("text").to_pylist()]}

    return through(texts.select("rep", "text"), make, "shingles array<long>", keep=("rep",))


def confirm(pairs: DataFrame, sets: DataFrame, threshold: float, share: int = 256) -> DataFrame:
    """The pairs whose full sets reach the threshold.

    A centre with many partners would gather its set's copies in one task, so its pairs are dealt over
    one lane for every ``share`` partners and its set is repeated once a lane.
    """
    centres = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    lanes = F.ceil(F.col("partners") / share).cast("int")
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a")).join(
        centres.withColumn("lanes", lanes), "a").withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))
    dealt = pairs.join(centres.select("a", lanes.alias("lanes")), "a").withColumn(
        "lane", F.pmod(F.xxhash64("b"), F.col("lanes")).cast("int")).select("a", "b", "lane")
    full = dealt.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")), "b").join(
        left.select("a", "lane", "set_a"), ["a", "lane"])
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    percent = round(threshold * 100)
    return full.where(shared * 100 >= union * percent).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id linked to it), kept.

    Two documents are linked if intersection over union of their word shingles is ``threshold`` or more.
    Thirty bands of five samples miss a pair at 0.8 with probability 7e-6, less above it.

    Documents with equal sets form a class with its smallest id as representative; only representatives
    are compared. Null, empty and wordless texts have no shingles, link with nothing and are kept. A
    repeated id is one node that has the links of all its rows; a null id takes part in nothing: its row comes
    back with its own n_shingles, a null component and kept true. No rows give no rows; other columns are ignored.
    """
    texts = docs.select("doc_id", "text")
    signed = materialize(sign(texts, size), "neardup-signed")
    nodes = signed.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    keys = nodes.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    owned = nodes.join(keys, "set_key")
    reps = materialize(owned.where("doc_id = rep").select("rep", "n_shingles", "bands", "sketch"), "neardup-reps")
    member = materialize(owned.select("doc_id", "rep"), "neardup-members")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a != z")
    same = member.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a != b")
    linker = Linker(reps, texts.withColumnRenamed("doc_id", "rep"), same, size, threshold)
    linker.run()
    rooted = linker.rooted(member).groupBy("doc_id").agg(F.min("root").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(rooted, "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
