"""Source divergence, packing and the prefix trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from camadas.llm import divergence, packing, prefixes
from camadas.llm.oracles import ORACLES
from camadas.llm.queries import WORD_BPE, op12_packing
from tests.conftest import rows as sorted_rows
from tests.llm.support import SF, frame, odd_rows

DOCS = "doc_id long, text string, lang string, source string"
SAID = "conv_id long, turn long, role string, text string"


def same(spark_rows, wanted):
    return sorted(map(tuple, spark_rows), key=str) == sorted(map(tuple, wanted), key=str)


# --- source divergence ------------------------------------------------------------------------


def by_sql(docs, least):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return con.execute(ORACLES["op11_source_divergence"].replace(">= 30", f">= {least}")).fetchall()


@pytest.mark.parametrize("least", [1, 2, 30])
def test_audit_odd_rows(spark, least):
    text = [(1, None, None, None), (2, "", "", ""), (3, "a a b É é", "en", "x"), (4, "a c É", "en", "y"), (5, "a\x00b", "en", None),
            (5, "12 3", "en", "z"), (6, "q", "fr", "x"), (7, None, "fr", "y")] + [(8, "a zz zé", "en", "x")] * 3
    docs = spark.createDataFrame(text, DOCS)
    assert same(divergence.audit(docs, least).collect(), by_sql(docs, least))
    odd = spark.createDataFrame(odd_rows(), DOCS)
    wide = frame(spark, odd_rows(), DOCS + ", term string, n string, total string, segment string, block string")
    assert same(divergence.audit(wide, least).collect(), by_sql(odd, least))


def test_audit_blocks_segments_and_flushes(spark, monkeypatch):
    for name, value in {"SEGMENT": 32, "BLOCK": 3, "PAIRS_AT_ONCE": 5, "HELD_TERMS": 50}.items():
        monkeypatch.setattr(divergence, name, value)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    assert same(divergence.audit(docs, 2).collect(), by_sql(docs, 2))


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_are_exact():
    rng = random.Random(0)
    for total in (7, 12_345, 10**9 + 7, 9 * 10**15):
        counts = [0, 1] + [rng.randrange(max(1, total - 5)) for _ in range(50)]
        counts = [c for c in counts if c + 5 <= total]
        got = divergence.shares(np.array(counts, dtype=np.int64), np.int64(total))
        assert got.tolist() == [1 + 10**9 * (c + 5) // total for c in counts]


def test_equal_subtrees_are_one_node():
    counts = np.array([[0, 1] * 64, [2, 0] * 64, [0] * 128])
    trees = divergence.SegmentTrees(counts)
    assert all(len(left) == 3 for left, _ in trees.levels)
    totals = np.array([1000, 1003, 900])
    p = np.stack([divergence.shares(c, t) for c, t in zip(counts, totals)])
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert trees.distances(totals, a, b).tolist() == np.abs(p[a] - p[b]).sum(axis=1).tolist()


# --- packing ----------------------------------------------------------------------------------


@pytest.mark.parametrize("histogram", [{}, {1: 3}, {1500: 100, 3: 7}, {2047: 1}, {64: 1}, {7: 1000, 33: 10, 64: 4, 50: 77},
                                       {n: n % 5 for n in range(1, 65)}])
@pytest.mark.parametrize("capacity", [64, 2048])
def test_plan_fills_every_pack(histogram, capacity):
    histogram = {n: c for n, c in histogram.items() if n <= capacity}
    placements = packing.plan(histogram, capacity)
    filled = Counter()
    for p in sorted(placements, key=lambda p: p.offset):
        for s in range(p.sequence, p.sequence + p.count):
            assert filled[s] == p.offset
            filled[s] += p.length
    assert sum(filled.values()) == sum(n * c for n, c in histogram.items())
    short = [n for n in filled.values() if n != capacity]
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)
    placed = packing.Placed(placements)
    for n, count in histogram.items():
        assert all(sum(size for _, size, _, _ in placed.pieces(n, rank)) == n for rank in range(count))


def test_plan_does_not_grow_with_documents():
    rng = random.Random(1)
    sizes = [len(packing.plan({n: rng.randint(1, top) for n in range(1, 2048)})) for top in (10, 10**4, 10**9)]
    assert max(sizes) < 3 * min(sizes) < 20_000


def check_pieces(docs, pieces, length=2048):
    library = Tokenizer.from_file(WORD_BPE)
    whole = sorted(((d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs), key=str)
    sequences, found = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, dtype="<u4").tolist()
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        found[p.doc_id].append((p.start, p.doc_tokens, ids))
    for runs in sequences.values():
        at = 0
        for offset, size in sorted(runs):
            assert offset == at
            at += size
        assert at == length or at < length and at & (at - 1) == 0
    return whole, found


def test_packed_pieces_are_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs, WORD_BPE).collect()
    whole, found = check_pieces([(r.doc_id, r.text) for r in docs.collect()], pieces)
    for doc_id, ids in whole:
        parts = sorted(found.pop(doc_id))
        assert [x for _, _, p in parts for x in p] == ids and {n for _, n, _ in parts} == {len(ids)}
        assert [s for s, _, _ in parts] == np.cumsum([0] + [len(p) for _, _, p in parts])[:-1].tolist()
    assert not found


def test_packing_odd_rows(spark):
    names = DOCS + ", ids string, rest string, task string, place string, rank string, full string"
    docs = frame(spark, odd_rows(), names)
    pieces = packing.pack(docs, WORD_BPE, length=128).collect()
    whole, found = check_pieces([(r[0], r[1]) for r in odd_rows()], pieces, 128)
    tokens = Counter()
    for doc_id, ids in whole:
        tokens[doc_id] += len(ids)
    assert tokens == Counter({d: sum(len(p) for _, _, p in parts) for d, parts in found.items()})
    assert packing.pack(spark.createDataFrame([], DOCS), WORD_BPE).collect() == []


def test_sequences_hold_their_pieces(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    pieces = packing.pack(docs, WORD_BPE, length=256)
    want = defaultdict(bytes)
    for p in sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset)):
        want[p.sequence_id] += p.ids
    got = packing.sequences(pieces).collect()
    assert {r.sequence_id: bytes(r.ids) for r in got} == want
    assert all(r.n_tokens == len(r.ids) // 4 == sum(p.length for p in r.pieces) for r in got)


def test_packing_query_digests(spark):
    got = op12_packing(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), WORD_BPE)
    assert Counter((p.doc_id, p.start, zlib.crc32(p.ids)) for p in pieces.collect()) == Counter(
        (r.doc_id, r.start, r.ids_crc32) for r in got.collect())


def test_chunks_give_the_library_s_ids(monkeypatch):
    alphabet = ["a", "B", "é", "É", "ß", "ſ", "K", "İ", "Σ", "σ", "ς", "'s", "'ll", "'", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n",
                "\t", "\r", "\x1c", "\xa0", " ", "́", "̸", "=", "<", ".", ",", "!", "1", "٣", "中", "한", "​", "\x85",
                "\x0b", "\x0c", "é", "ﬁ", "ǅ", "𝒳", "😀"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for words in (packing.WORDS, 50):
        monkeypatch.setattr(packing, "WORDS", words)
        encoder = packing.Encoder(WORD_BPE)
        assert encoder.chunked and encoder.bare
        library = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for at in range(0, len(texts), 500):
            assert [x.tolist() for x in encoder(pa.array(texts)[at:at + 500])] == library[at:at + 500]


# --- prefix trie ------------------------------------------------------------------------------


def plain_trie(rows):
    """The contract in plain Python, conversations and nodes by their turns themselves."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[conv].append(((turn is not None, turn or 0, order), (role, text)))
    own = {c: [x for _, x in sorted(turns)] for c, turns in said.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members, children, out = defaultdict(list), defaultdict(list), {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        who, kids = members[node], children[node]
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))
        out[node] = (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids),
                     sum(out[k][5] for k in kids) if kids else 1,
                     sum(out[k][6] for k in kids) + (len(who) - 1) * (len(node[-1][1].encode()) if node else 0),
                     hashlib.sha256(ends.encode()).hexdigest())
    return list(out.values())


@pytest.mark.parametrize("seed, convs, longest", [(0, 40, 9), (1, 200, 12), (2, 4, 3), (3, 600, 9), (4, 150, 60)])
def test_trie_of_random_conversations(spark, monkeypatch, seed, convs, longest):
    if seed == 3:  # many tasks and levels of tasks, digests of chunks
        for name, value in {"TURNS_A_TASK": 40, "FEWER": 4, "ID_BYTES": 100}.items():
            monkeypatch.setattr(prefixes, name, value)
    rng, rows = random.Random(seed), [(None, 0, "a", "b")] * 2
    for c in range(-12 if seed % 2 else 0, convs):
        for t in range(rng.choice([1, 2, 3, longest // 2, longest]) if rng.random() < 0.9 else 0):
            turn = rng.choice([t, t, None]) if seed == 1 else t
            role = rng.choice(["user", None, ""]) if t % 2 else "user"
            rows.append((c, turn, role, "hé" * (t % 4) if rng.random() < 0.93 else rng.choice(["a", "b", None])))
    rows += rows[5:9]
    wide = frame(spark, rows, SAID + ", base string, own string, path string, depth string, h string")
    got = prefixes.prefix_trie(wide.repartition(3)).collect()
    assert same(got, plain_trie(rows))


def test_trie_of_copies_fills_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "ID_BYTES", 200)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(400) for t in range(4)] + [(1, 0, "user", "turn 0")]
    got = prefixes.prefix_trie(spark.createDataFrame(rows, SAID)).collect()
    assert same(got, plain_trie(rows))
    runs = prefixes.endings(prefixes.rebuilt(spark.createDataFrame(rows, SAID)))
    assert runs.agg(F.sum("n")).first()[0] == 401


def test_trie_of_nothing(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], SAID)).collect() == []
    assert prefixes.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SAID)).collect() == []
    only = spark.createDataFrame([(1, None, None, None)], SAID)
    assert sorted_rows(prefixes.prefix_trie(only)) == sorted(map(tuple, plain_trie([(1, None, None, None)])), key=str)


def test_spelled_words_and_stops_are_the_librarys_ids_without_the_library():
    encoder, asked = packing.Encoder(WORD_BPE), []
    texts = ["çéüxñ&&& Oianè### straße*** river.", "ª º µ ÿ Ÿ İ ſ ﬁ", "foo''s bar's don't a.'s b!'s", "x<|endoftext|>y a.1 1,2 a\\\\ [[b]]",
             "é́é ab́&&& a\x1fb"]
    for text in texts:
        want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert next(iter(encoder(pa.array([text])))).tolist() == want.tolist(), text

    class Watched:
        model = encoder.tokenizer.model

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return kept.encode_batch_fast(texts, **options)

    kept, encoder.tokenizer = encoder.tokenizer, Watched()
    encoder.young, encoder.old = {"": b""}, {}
    list(encoder(pa.array([texts[0]])))
    assert set(asked) <= {"&&&", "###", "***", "."}


def test_chunks_are_cut_in_arrow_as_by_their_characters():
    encoder, rng = packing.Encoder(WORD_BPE), random.Random(3)
    letters = ["a", "Z", "é", "É", "ß", "ÿ", "ª", "µ", "Ā", "İ", "1", "_", ".", ",", "!", "]", "-", "\\", "'", "\n", "\x85", "中", "😀"]
    chunks = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(5000)})
    words, stops = (x.to_pylist() for x in encoder.cut(pa.array(chunks)))
    for chunk, word, stop in zip(chunks, words, stops):
        core = chunk.rstrip(encoder.stops)
        plain = core.isalpha() and max(core) < packing.LATIN_END
        assert (word, stop) == ((core.lower(), chunk[len(core):]) if plain else (chunk, "")), chunk
