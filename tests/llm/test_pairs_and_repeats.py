"""Near-duplicates, repeated substrings, boilerplate lines and leaks against plain versions."""

import hashlib
import pickle
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from camadas.llm import decontaminate, lines, neardup, substrings
from tests.llm.support import SF, frame, odd_rows, prose


def shingles(text, size):
    words = text.encode().lower().split() if text else []
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_components(rows, size):
    """By comparing all pairs of rows."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: top(i) for i in root}


def variants(seed, n, words=120):
    """Copies of a text with a few words changed, so that some pairs are links and some are not."""
    rng, base = random.Random(seed), prose(seed, words).split()
    out = []
    for k in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(0, 8)):
            copy[at] = f"w{seed}x{k}x{at}"
        out.append(" ".join(copy))
    return out


def check_components(spark, rows, size):
    found = neardup.near_duplicates(frame(spark, [(i, t) for i, t in rows]), size).collect()
    assert len(found) == len(rows)
    want = plain_components(rows, size)
    for r in found:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    by_id = defaultdict(set)
    for i, t in rows:
        by_id[i].add(len(shingles(t, size)))
    assert all(r.n_shingles in by_id[r.doc_id] for r in found)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    texts = [t for s in range(4) for t in variants(s, 12)] + [prose(100 + k, 80) for k in range(20)]
    random.Random(1).shuffle(texts)
    odd = [(r[0], r[1]) for r in odd_rows()]
    check_components(spark, odd + [(1000 + 3 * k, t) for k, t in enumerate(texts)], size)


def test_near_duplicates_in_large_buckets(spark, monkeypatch):
    """Chains and unlinked templates in one bucket: the pair and the prefix paths settle what stars leave."""
    monkeypatch.setattr(neardup, "STAR_ROUNDS", 1)
    monkeypatch.setattr(neardup, "PROGRESS", 0.0)
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 4)
    base = prose(9, 100).split()
    chain = [" ".join(f"c{j}" if j < 7 * k else w for j, w in enumerate(base)) for k in range(8)]
    template = [" ".join([*base[:70], *prose(500 + k, 30).split()]) for k in range(40)]
    check_components(spark, list(enumerate(chain + template)), 2)


def test_no_rows(spark):
    none = frame(spark, [])
    assert neardup.near_duplicates(none).count() == 0
    assert substrings.digest(none).count() == 0
    assert lines.drop_boilerplate(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(frame(spark, odd_rows()), items).count() == 0


def test_odd_sketch_estimates_similarity():
    signer = neardup.Signer()
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 2**63, 900).astype("u8")
    same = [signer.sketch(signer.minima(np.unique(np.append(shared, rng.integers(0, 2**63, 50).astype("u8"))))) for _ in range(20)]
    far = [signer.sketch(signer.minima(rng.integers(0, 2**63, 900).astype("u8"))) for _ in range(20)]

    def bits(a, b):
        return int(np.bitwise_count((a ^ b).view("u8")).sum())

    limit = neardup.most_differing_bits(0.8)
    assert max(bits(a, b) for a, b in zip(same, same[1:])) <= limit < min(bits(a, b) for a, b in zip(far, far[1:]))


def plain_removal(rows):
    """Every 100-byte string in order of id, text order of equal ids and place."""
    seen, out = {}, {}
    for key in sorted(set(rows)):
        raw = key[1]
        flags = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            if seen.setdefault(raw[s:s + 100], (key, s)) != (key, s):
                flags[s:s + 100] = True
        starts = int((np.diff(np.append(0, flags.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(raw, "u1")[~flags])
        out[key] = (len(raw), int(flags.sum()), starts, hashlib.sha256(kept).hexdigest())
    return out


def check_removal(found, rows):
    ordered = [(i, substrings.text_mark((t or "").encode()), (t or "").encode()) for i, t in rows]
    ordered = [(substrings.NO_ID if i is None else i, m, raw) for i, m, raw in ordered]
    want = plain_removal([((i, m), raw) for i, m, raw in ordered])
    expected = sorted((i, *want[((i, m), raw)]) for i, m, raw in ordered)
    got = sorted((substrings.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == expected


@pytest.mark.parametrize("block", [400, 4_000_000])
def test_repeated_substrings(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    rng = random.Random(4)
    passages = [prose(200 + k, 25) for k in range(6)]
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] != 8]
    for k in range(60):
        cut = rng.choice(passages)
        cut = cut[rng.randint(0, 40):len(cut) - rng.randint(0, 40)]
        rows.append((100 - k, f"{prose(300 + k, 10)} {cut}{rng.choice(['', ' é', 'x'])} {prose(400 + k, 12)}"))
    rows += [(700, "ab" * 300), (701, "a" * 450), (702, "\0" * 130 + prose(1, 30)), (703, "ab" * 220 + "c"), (704, prose(1, 30))]
    found = substrings.digest(frame(spark, rows).repartition(5)).collect()
    check_removal(found, rows)


def test_repeated_substrings_of_a_crowded_hash(spark, monkeypatch):
    """A passage with other neighbours in every document: no block takes all contexts of its hashes."""
    monkeypatch.setattr(substrings, "CROWD", 20, raising=False)
    blocks, compare = [], substrings.compare_contexts

    def watched(contexts, n):
        blocks.append(contexts.groupBy("h").count().agg({"count": "max"}).first()[0])
        return compare(contexts, n)

    monkeypatch.setattr(substrings, "compare_contexts", watched)
    passage = prose(777, 40)
    rows = [(500 - k, f"{prose(2000 + k, 15)} {passage} {prose(3000 + k, 15)}") for k in range(150)]
    rows += [rows[3], (None, rows[5][1]), (497, rows[9][1] + "!"), (800, "ab" * 300), (801, passage), (802, None)]
    found = substrings.digest(frame(spark, rows).repartition(7)).collect()
    check_removal(found, rows)
    assert max(b or 0 for b in blocks) <= 20


def test_repeated_substrings_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_removal(substrings.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_prefix_lengths_by_interval_expansion():
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"ab\xff") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    flat = np.frombuffer(b"\0".join(texts) + b"\0", "u1").astype("i2") + 1
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    flat[ends] = 0
    order, rank = substrings.suffix_array(flat)
    suffixes = [(bytes((flat[i:ends[np.searchsorted(ends, i)]] - 1).astype("u1")), int(np.searchsorted(ends, i))) for i in order]
    assert [(tuple(s), n) for s, n in suffixes] == sorted((tuple(s), n) for s, n in suffixes)
    for least in (1, 3, 6):
        known = substrings.common_prefixes(flat, order, rank, least)
        for i in range(1, len(order)):
            a, b = suffixes[i - 1][0], suffixes[i][0]
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert known[i] == (common < least)


def test_boilerplate_lines(spark):
    rows = [(k, f"intro {k}\nshared footer \r\n\nrare {k // 5}", "en", f"site{k % 7}") for k in range(30)]
    rows += [(50, "shared footer", "en", None), (51, None, "en", "a"), (52, "", None, "a"), (53, "shared footer\nshared footer", "en", "z")]
    out = {r.doc_id: r for r in lines.drop_boilerplate(frame(spark, rows), least_sites=7).collect()}
    assert len(out) == len(rows)
    assert out[0].text == "intro 0\n\nrare 0" and (out[0].n_lines, out[0].n_removed) == (3, 1)
    assert out[50].text == "" and out[51].text is None and out[52].text == "" and out[53].n_removed == 2
    assert out[51].n_lines == 0 and out[0].key == "x"
    more = {r.doc_id: r for r in lines.drop_boilerplate(frame(spark, rows), least_sites=9).collect()}
    assert not any(r.n_removed for r in more.values())  # eight sites: seven and z, the null one not counted


def test_boilerplate_beside_a_column_with_a_dot(spark):
    rows = [(k, "shared footer\nown {k}", "en", f"s{k}", 7) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `a.b` int")
    out = lines.drop_boilerplate(docs, least_sites=5)
    assert "a.b" in out.columns and {(r["a.b"], r.n_lines) for r in out.collect()} == {(7, 2)}


def test_line_spread_is_exact_at_the_threshold(spark):
    """With hundreds of sites the sketch only estimates; the count near the threshold is exact."""
    rows = [(k * 1000 + s, f"line {k}", "en", f"s{s}") for k, n in ((0, 299), (1, 300), (2, 301), (3, 500), (4, 20)) for s in range(n)]
    keys = lines.boilerplate(frame(spark, rows), 300)
    assert {bytes(r.key) for r in keys.collect()} == {hashlib.md5(f"line {k}".encode()).digest() for k in (1, 2, 3)}


def plain_leaks(docs, items):
    """Longest common subsequence of every item with every stretch of every text, by the textbook table."""
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    strip = decontaminate.EDGE
    out = set()
    for i, t in docs:
        words = [w.strip(strip) for w in (t or "").encode().lower().split()]
        for n, text in items:
            item = [w.strip(strip) for w in (text or "").encode().lower().split()]
            size = 2 * len(item) + decontaminate.PASSAGE
            best = max((lcs(item, words[s:s + size]) for s in range(0, max(1, len(words)), 16)), default=0)
            if n is not None and item and best >= 0.7 * len(item):
                out.add((i, n))
    return out


def test_leaks(spark):
    items = [(k, f"{prose(900 + k, 20)}?\n{prose(950 + k, 6)}.") for k in range(8)] + [(90, None), (91, ""), (None, prose(1, 20))]
    docs = [(r[0], r[1]) for r in odd_rows() if r[0] != 8] + [(100 + k, prose(1000 + k, 150)) for k in range(20)]
    for k in range(8):
        noisy = items[k][1].split()
        noisy[3:5] = ["changed"]
        docs += [(200 + k, f"{prose(k, 50)} {items[k][1]} {prose(k + 50, 77)}"), (300 + k, f"{prose(k, 31)} {' '.join(noisy)}")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, docs), table).collect()}
    assert found == plain_leaks(docs, items)
    assert {(200 + k, k) for k in range(8)} | {(300 + k, k) for k in range(8)} <= found


def test_leaks_that_look_unlike_their_item(spark):
    """Items among a much repeated word, and with most words but the answer's replaced, against all windows."""
    rng = random.Random(12)
    items = [(k, f"{' '.join(f'q{k}w{j}' for j in range(20 if k % 2 else 12))}?\n{' '.join(f'a{k}w{j}' for j in range(5))}.") for k in range(30)]
    docs = [(k, prose(k, 100)) for k in range(20)]
    for k, text in items:
        words, fill = text.split(), prose(4000 + k, 60).split()
        docs.append((100 + k, " ".join([*fill[:30], *(f"{w} rep{k} rep{k}" for w in words), *fill[30:]])))
        for n, share in enumerate((0.3, 0.4, 0.5)):
            asked = len(words) - 5
            changed = set(rng.sample(range(asked), min(asked, round(share * len(words)))))
            mixed = [rng.choice(fill) if j in changed else w for j, w in enumerate(words)]
            docs.append((200 + 100 * n + k, " ".join([*fill[:rng.randint(0, 30)], *mixed, "filler " * 20, *fill[30:]])))
    plain, order = set(), {}

    def own(text):
        bare = (w.strip(decontaminate.EDGE) for w in text.encode().lower().split())
        return np.array([order.setdefault(w, len(order)) for w in bare])

    for i, t in docs:
        words = own(t)
        for n, text in items:
            item = decontaminate.Item(n, own(text), own(text.split("\n")[-1]))
            size = len(item.words)
            for at in range(0, len(words), decontaminate.STEP):
                region = words[max(0, at - size):at + decontaminate.PASSAGE + size]
                share = decontaminate.common_subsequence(item.words, region) / size
                answer = decontaminate.common_subsequence(item.answer, region) / len(item.answer)
                if share >= 0.7 or share >= 0.55 and answer >= 0.8:
                    plain.add((i, n))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, docs), table).collect()}
    assert found == plain and {(100 + k, k) for k in range(30)} <= found
    assert any(300 <= i < 400 for i, _ in found)


def test_words_that_only_look_equal_are_no_leak(spark):
    """13 of an item's 20 words and another word with the number of the 14th: 0.65, not 0.70."""
    numbers, item = decontaminate.Numbers(), [f"item{k}" for k in range(20)]
    wanted = numbers[item[13].encode()]
    twin = next(w for w in (f"other{k}" for k in range(10**6)) if numbers[w.encode()] == wanted)
    fill = prose(77, 60).split()
    docs = [(k, " ".join([*fill[:30], *item[:13], w, *fill[30:]])) for k, w in ((1, twin), (2, item[13]), (None, twin))]
    table = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    found = decontaminate.find_leaks(frame(spark, docs), table).collect()
    assert [(r.doc_id, r.item_id, r.lcs_share) for r in found] == [(2, 5, 0.7)]


def test_leaks_with_the_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 3)
    items = [(k, prose(900 + k, 20)) for k in range(8)]
    docs = [(k, f"{prose(k, 40)} {items[k][1]} {prose(k, 40)}") for k in range(8)]
    found = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(k, k) for k in range(8)}


def test_driver_holds_no_matrix_of_items_by_features():
    """Pieces of 400 items are 1,200 rows of 8192 numbers, 79 MB a copy; tasks make the words' counts themselves."""
    rng = np.random.default_rng(3)
    seen, sketch = rng.integers(0, 900, decontaminate.FEATURES), rng.normal(size=(64, decontaminate.FEATURES))
    items = [decontaminate.as_item(k, prose(k, 70)) for k in range(400)]
    tracemalloc.start()
    try:
        index = decontaminate.Index(items, 1e5, seen, sketch)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    assert len(pickle.dumps(index)) < 6e6
    assert index.counts.sum() == index.sizes.sum()


def test_latent_basis_is_that_of_the_whole_matrix():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(70, decontaminate.FEATURES)) * np.geomspace(1, 1e-3, 70)[:, None]
    strength, basis = decontaminate.latent_basis(lambda: (a[at:at + 32] for at in range(0, 70, 32)), 20)
    _, whole, vectors = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(strength, whole[:20], rtol=1e-9)
    assert np.allclose(np.abs((basis * vectors[:20]).sum(axis=1)), 1, atol=1e-6)
    none, empty = decontaminate.latent_basis(lambda: iter([np.zeros((2, decontaminate.FEATURES))]), 20)
    assert not len(none) and empty.shape == (0, decontaminate.FEATURES)
