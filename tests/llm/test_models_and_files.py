"""Classifiers, language, token files, top-k, mixture and pipeline against plain versions."""

import functools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from camadas.llm import common, language, mixing, quality, queries, tokens, topk, toxicity
from camadas.llm.common import fold, isotonic
from camadas.llm.oracles import ORACLES
from tests.llm.support import SF, frame, odd_rows, prose
from workload.check import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ""


def labels_of(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


def test_quality_on_held_out_rows(spark):
    rng = random.Random(2)
    rows = [(k, prose(k, rng.randint(20, 200)) if k % 3 else "spam!! " * rng.randint(10, 200), "en", "a") for k in range(600)]
    labels = labels_of(spark, [(k, int(bool(k % 3))) for k in range(600)] + [(None, 1), (1, None), (2, 7), (9999, 1)], "quality")
    docs = frame(spark, rows + odd_rows())
    out = quality.score_quality(docs, labels, fold("doc_id", 4, 2)).collect()
    assert len(out) == len(rows) + len(odd_rows()) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and 20 < r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.predicted == bool(r.doc_id % 3) for r in held]) > 0.97


def test_classifiers_without_labels_or_rows(spark):
    none = labels_of(spark, [], "quality")
    assert {r.score for r in quality.score_quality(frame(spark, odd_rows()), none, F.lit(False)).collect()} == {0.5}
    assert quality.score_quality(frame(spark, []), none, F.lit(False)).count() == 0
    toxic = labels_of(spark, [], "toxic")
    assert {r.score for r in toxicity.score_toxicity(frame(spark, odd_rows()), toxic, F.lit(False)).collect()} == {0.0}
    assert toxicity.score_toxicity(frame(spark, []), toxic, F.lit(False)).count() == 0


def test_sums_reach_the_driver_once(spark, monkeypatch):
    """One vector, whatever the number of tasks that add to it; its length is no multiple of a slice."""
    size, got, kind = 2 * common.SLICE + 5, [], type(spark.range(0))
    collect = kind.collect

    def seen(df):
        rows = collect(df)
        got.extend(len(r.blob) for r in rows)
        return rows

    monkeypatch.setattr(kind, "collect", seen)
    rows = spark.range(24).repartition(6)
    total = common.partial_sums(rows, lambda frame: np.arange(size) * float(frame["id"].sum()))
    assert np.array_equal(total, np.arange(size) * 276.0)
    assert sum(got) == 8 * size
    assert common.partial_sums(rows.where("id < 0"), lambda frame: np.ones(3)) is None


def test_isotonic_pools_violators():
    xs, ys = isotonic([(0, 10, 1), (1, 10, 6), (2, 10, 2), (3, 10, 9)])
    assert list(xs) == [0, 0, 1, 2, 3, 3] and (np.diff(ys) >= 0).all()


def test_maximal_segments_against_all_segments():
    """The best segment overall, then the best in what is left on either side, and so on."""
    def plain(scores, start=0):
        sums = np.append(0, np.cumsum(scores))
        best = max(((sums[e] - sums[s], -(e - s), s, e) for s in range(len(scores)) for e in range(s + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, s, e = best
        return [*plain(scores[:s], start), (start + s, start + e, best[0]), *plain(scores[e:], start + e)]

    rng = random.Random(5)
    for _ in range(200):
        scores = [rng.choice([-0.25] * 3 + [-1.7, 0.53, 1.31, 0.2]) for _ in range(rng.randint(0, 18))]
        found = toxicity.segments(np.array(scores))
        assert round(sum(x[2] for x in found), 6) == round(sum(x[2] for x in plain(scores)), 6)
        assert len(found) == len(plain(scores))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(3)
    rows = []
    for k in range(500):
        words = prose(k, rng.randint(30, 120)).split()
        for _ in range(4 if k % 4 == 0 else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["vilebad", "grimbad", "foul"]) + rng.choice(["", "er", "est"]))
        rows.append((k, " ".join(words), "en", "a"))
    labels = labels_of(spark, [(k, int(k % 4 == 0)) for k in range(500)], "toxic")
    out = toxicity.score_toxicity(frame(spark, rows + [(1000, None), (1001, "")]), labels, fold("doc_id", 5, 0)).collect()
    assert all(r.predicted == 0 and r.passages == [] for r in out if r.doc_id >= 1000)
    held = [r for r in out if r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97


def plain_toxicity(rows, labels, held):
    """(doc_id, score) with dictionaries of strings, all segments by recursion-free search, and no Spark."""
    counts, clean = (Counter(), Counter()), []
    train = [(toxicity.tokens(text), labels[k]) for k, text in rows if labels.get(k) in (0, 1) and not held(k)]
    for words, y in train:
        counts[y].update(words)
        clean.extend(words if y == 0 else [])
    good, bad = (sum(c.values()) for c in counts)
    spread = (Counter(), Counter())
    for c, out in zip(counts, spread):
        for w, n in c.items():
            for u in toxicity.units(w):
                out[u] += n

    @functools.cache
    def score(word):
        odds = []
        for u in toxicity.units(word):
            seen = u in spread[0] or u in spread[1]
            here = np.log(spread[1][u] * (good + bad) / bad + toxicity.PRIOR) - np.log(spread[0][u] * (good + bad) / good + toxicity.PRIOR)
            odds.append(float(np.float32(here)) if seen and abs(np.float32(here)) >= toxicity.EVEN else 0.0)
        return round((sum(odds) / len(odds) - toxicity.DRIFT) * toxicity.STEPS) / toxicity.STEPS

    values = np.round(np.array([score(w) for w in clean]) * 100) / 100
    low, high = 0.0, 50.0
    for _ in range(80):
        rate = (low + high) / 2
        low, high = (rate, high) if np.exp(rate * values).mean() < 1 else (low, rate)
    chance = (values > 0).mean()

    def evidence(words):
        total, spans = 0.0, [(0, len(words))]
        scores = np.array([score(w) for w in words])
        while spans:
            first, last = spans.pop()
            lowest, at, best, where = 0.0, first, 0.0, None
            run = 0.0
            for i in range(first, last):
                run += scores[i]
                if run - lowest > best:
                    best, where = run - lowest, (at, i + 1)
                if run <= lowest:
                    lowest, at = run, i + 1
            if where:
                total += max(0.0, -np.log(len(words) * chance) + low * best)
                spans += [(first, where[0]), (where[1], last)]
        return np.log1p(total) * 10

    bins = {}
    for words, y in train:
        n, s = bins.get(k := min(int(evidence(words) / (toxicity.TOP / 2000)), 2000), (0, 0))
        bins[k] = (n + 1, s + y)
    xs, ys = isotonic([((k + 0.5) * (toxicity.TOP / 2000), n, s) for k, (n, s) in bins.items()])
    return {k: float(np.interp(evidence(toxicity.tokens(text)), xs, ys)) for k, text in rows}


def test_toxicity_query_against_plain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    expected = plain_toxicity(docs, labels, held)
    out = queries.op8_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(expected)
    assert max(abs(r.score - expected[r.doc_id]) for r in out) < 1e-6
    assert all(r.predicted == (r.score >= 0.5) and r.held_out == held(r.doc_id) for r in out)


def test_rare_words_score_less_than_frequent_ones(spark):
    rows = [("seldom", 1, 0), ("often", 60, 0), ("clean", 0, 60), ("both", 50, 500), ("once", 0, 1)]
    counts = spark.createDataFrame([(toxicity.key_of(u.encode()), True, b, g) for u, b, g in rows], "unit long, whole boolean, bad long, good long")
    words = toxicity.Scores(*toxicity.log_odds(counts))
    often, seldom, once, clean, unseen = words.of([b"often", b"seldom", b"once", b"clean", b"new"])
    assert often > seldom > unseen == once == -toxicity.DRIFT > clean


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(queries.PIECES, [("a", 300, 5), ("a", 400, 2), ("b", 300, 1)])
    texts = {}
    from sentencepiece import SentencePieceProcessor
    encoder = SentencePieceProcessor(model_file=queries.PIECES)
    for i in range(encoder.vocab_size()):
        if not (encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i)):
            texts[encoder.id_to_piece(i)] = pieces.probabilities[np.searchsorted(pieces.keys, np.uint64(pieces._hash(encoder.id_to_piece(i))))]

    def plain(word):
        if not word:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, min(len(word), pieces.longest) + 1):
            p = texts.get(word[:n], np.full(2, language.UNKNOWN) if n == 1 else np.zeros(2))
            total = total + p * plain(word[n:])
        return total

    words = ["house", "maison", "größe", "日本語x", "a"]
    assert np.allclose(pieces.score(words), [np.log(plain("▁" + w)) for w in words])


def test_long_words_of_unseen_pieces_with_large_counts():
    """Forty one-character pieces that no language has seen, beside counts of a large corpus."""
    pieces = language.Pieces(queries.PIECES, [("a", 300, 10**9), ("b", 400, 2 * 10**9)])
    shown = {pieces._hash(c): c for c in map(chr, range(0x4E00, 0x9FFF))}
    char = next(shown[int(k)] for k in pieces.keys if int(k) in shown)
    row = pieces.probabilities[np.searchsorted(pieces.keys, np.uint64(pieces._hash(char)))]
    first, words = pieces.score([char])[0], [char * 40, char * 80, "house"]
    scores = pieces.score(words)
    assert np.isfinite(scores).all()
    assert np.allclose(scores[0], first + 39 * np.log(row)) and np.allclose(scores[1], first + 79 * np.log(row))
    names, best = pieces([f"{char * 40} house", char * 200])
    assert np.isfinite(best).all() and (best > 0).all() and set(names) <= {"a", "b"}


def plain_language(rows, held):
    """(doc_id, lang_pred, score) by strings: a dict of pieces and one sum of logarithms per word."""
    from sentencepiece import SentencePieceProcessor
    encoder = SentencePieceProcessor(model_file=queries.PIECES)
    usable = [i for i in range(encoder.vocab_size()) if not (encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i))]
    counts = {}
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and not held(doc_id):
            for w in language.lettered(text.lower().split()):
                counts.setdefault(lang, Counter()).update(encoder.encode(w))
    langs = sorted(counts)
    table = {}
    for lang in langs:
        total = sum(counts[lang][i] + language.SMOOTHING for i in usable)
        for i in usable:
            table.setdefault(encoder.id_to_piece(i), []).append(np.log((counts[lang][i] + language.SMOOTHING) / total))
    table = {piece: np.array(row) for piece, row in table.items()}
    longest = max(map(len, table))

    @functools.cache
    def word_score(word):
        word = "▁" + word
        reach = [np.zeros(len(langs))]
        for j in range(1, len(word) + 1):
            terms = [reach[i] + table[word[i:j]] for i in range(max(j - longest, 0), j) if word[i:j] in table]
            if word[j - 1] not in table:
                terms.append(reach[j - 1] + np.log(language.UNKNOWN))
            reach.append(np.logaddexp.reduce(terms))
        return reach[-1]

    for doc_id, text, _ in rows:
        words = (text or "").lower().split()
        told = language.lettered(words)
        if not told:
            yield doc_id, "und", 0.0
            continue
        total = np.sum([word_score(w) for w in told], axis=0) * min(1, language.SURE / len(words))
        odds = np.exp(total - total.max())
        yield doc_id, langs[int(odds.argmax())], odds.max() / odds.sum()


def test_language_query_against_plain(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    long = [(10**6, "x" * 41 + "straße" * 30, None), (10**6 + 1, "the " + "ab中" * 700, "en"), (10**6 + 2, "a" * 60, None)]
    docs = docs.unionByName(spark.createDataFrame(long, docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    expected = {k: (lang, score) for k, lang, score in plain_language(rows, lambda k: zlib.crc32(str(k).encode()) % 4 == 2)}
    out = queries.op3_language(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) == len(expected)
    for r in out:
        assert r.lang_pred == expected[r.doc_id][0] and abs(r.score - expected[r.doc_id][1]) < 1e-6
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_does_not_depend_on_blocks(monkeypatch):
    counts = [(lang, i, (i * k) % 97) for k, lang in ((7, "a"), (11, "b")) for i in range(300, 3000)]
    words = ["house", "mouse", "x" * 41, "abc" * 30, "日本" * 400, "▁"]
    whole = language.Pieces(queries.PIECES, counts).score(words)
    for size in (1, 7, 50):
        monkeypatch.setattr(language, "AT_ONCE", size)
        assert np.allclose(language.Pieces(queries.PIECES, counts).score(words), whole, rtol=1e-12)
    monkeypatch.setattr(language, "REMEMBERED", 10)
    pieces = language.Pieces(queries.PIECES, counts)
    names, best = pieces(words)
    assert pieces(words[::-1])[0] == names[::-1] and len(pieces.known) <= len(words)


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.identify(docs, fold("doc_id", 4, 2), queries.PIECES).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count()
    odd = language.identify(frame(spark, odd_rows()), F.lit(False), queries.PIECES).collect()
    assert len(odd) == len(odd_rows())
    assert Counter(r.lang_pred for r in odd if r.doc_id in (1, 2, 3, 10)) == {"und": 4}
    untaught = language.identify(frame(spark, odd_rows()), F.lit(True), queries.PIECES).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.identify(frame(spark, []), F.lit(False), queries.PIECES).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.BYTE_BPE)
    whole.encode_special_tokens = True
    strange = ["a  b", "a   b ", " lead", "tail ", "x\n y", "x\n\n y", "it's we'll 12 34!!", "日本 語 x", "  ", "a \n b", "<|endoftext|> z"]
    rows = odd_rows() + [(5000 + k, t, "en", "a") for k, t in enumerate(strange)]
    folder = f"file://{tmp_path}/t"
    parts = tokens.write_sequences(frame(spark, rows), folder, queries.BYTE_BPE, length=64)
    found = tokens.read_documents(parts, folder).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    start, everything = 0, []
    for r, (doc, text, *_) in zip(found, order, strict=True):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        everything.append(ids)
    flat = []
    for row in sorted(parts.collect()):
        reader = tokens.open_part(folder, f"part-{row.part:06d}.arrow")
        for i in range(sum(reader.get_batch(b).num_rows for b in range(reader.num_record_batches))):
            ids, mask = tokens.sequence(reader, i)
            assert len(ids) == 64 and not ids.flags.owndata
            flat.append(ids[mask.to_numpy(zero_copy_only=False)])
    assert (np.concatenate(flat) == np.concatenate(everything)).all()
    assert tokens.encode(frame(spark, []), queries.BYTE_BPE).count() == 0


def test_added_tokens_get_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.BYTE_BPE)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|> b  c", "x <|endoftext", "no token here"]
    docs = frame(spark, list(enumerate(texts)))
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokens.encode(docs, queries.BYTE_BPE).collect()}
    for k, text in enumerate(texts):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert found[k] == (len(ids), zlib.crc32(ids.tobytes()))


def test_top_k_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=6).round(1)], 0) for k in range(300)]
    rows += [(400, None, 0), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (402, [float("nan")] * 6, 0), (403, [float("inf")] * 6, 0),
             (None, [1.0] * 6, 0), (404, [], 0), (500, rows[0][1], 0), (600, [0.0] * 6, 0)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"), F.col("vec_id") % 100 == 0, 7).collect()
    fine = {i: np.floor(1024 * np.array(v, "f4").astype("f8")).astype(int) for i, v, _ in rows[:300] + rows[-2:]}
    want = []
    for q in (i for i in fine if i % 100 == 0):
        best = sorted((-int(fine[q] @ v), i) for i, v in fine.items() if i != q)[:7]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, found)) == sorted(want)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_mixture(spark):
    rng = random.Random(6)
    rows = odd_rows() + [(100 + k, prose(k, rng.randint(1, 60)), "en", rng.choice(["hot"] * 6 + ["p", "q", None])) for k in range(900)]
    out = mixing.mix(frame(spark, rows), quality=F.when(F.col("doc_id") > 200, F.lit(1.0)))
    again = mixing.mix(frame(spark, rows).repartition(3), quality=F.when(F.col("doc_id") > 200, F.lit(1.0)))
    found = out.collect()
    assert sorted(map(str, found)) == sorted(map(str, again.collect()))
    assert len(found) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in found)
    sizes, targets, took = Counter(), {}, Counter()
    for r in found:
        sizes[r.source] += r.size
        targets[r.source] = r.target
        took[r.source] += r.taken
    assert all(t <= 2 * sizes[s] + 1e-6 for s, t in targets.items())
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-6
    longest = {s: max(r.size for r in found if r.source == s) for s in sizes}
    assert all(abs(took[s] - targets[s]) <= longest[s] / 2 + 1 for s in sizes)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_rows_without_id_are_drawn_one_by_one(spark):
    """Of equal weights, the chosen ones must not be the shortest or the longest, as one shared draw would make them."""
    rows = [(None, " ".join(["word"] * (1 + k // 4)) + f" x{k}", "en", "a") for k in range(400)]
    rows += [(k, "one two three", "en", "b") for k in range(20000, 20400)]
    out = mixing.mix(frame(spark, rows), share=0.5, quality=F.lit(1.0)).where("source = 'a'").collect()
    taken = sorted(r.size for r in out if r.copies)
    assert len(out) == 400 and 0 < len(taken) < 400
    assert abs(sum(r.taken for r in out) - out[0].target) <= max(r.size for r in out)
    assert taken[0] < 20 and taken[-1] > 80


def test_pipeline_stage_by_stage(spark):
    """Every stage's decisions, recomputed plainly on what the stage before it kept."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {}
    frame_ = documents
    for name, stage in corpus_pipeline.STAGES:
        frame_ = corpus_pipeline.materialize(stage(spark, frame_, SF), f"test-{name}")
        docs[name] = frame_.collect()
        assert name == "tokens" or frame_.columns == documents.columns
    good = queries.op7_quality(spark, SF).where("predicted = 1")
    assert {r.doc_id for r in docs["quality"]} == {r.doc_id for r in good.collect()}
    sets = [(r.doc_id, {tuple(r.text.encode().lower().split()[i:i + 5]) for i in range(max(1, len(r.text.split()) - 4))}) for r in docs["quality"]]
    alone = {r.doc_id for r in docs["near_duplicates"]}
    linked = {b for i, (a, x) in enumerate(sets) for b, y in sets[:i] + sets[i + 1:] if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    assert alone == {a for a, _ in sets} - linked
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in docs["near_duplicates"] if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert {r.doc_id for r in docs["decontamination"]} == alone - leaky
    copies = Counter(r.doc_id for r in docs["mixture"])
    size = {r.doc_id: len(r.text.split()) for r in docs["decontamination"]}
    words = sum(size[i] * n for i, n in copies.items())
    assert set(copies) <= set(size) and max(copies.values()) <= 2 and abs(words - 1.5 * sum(size.values())) < 0.2 * sum(size.values())
    assert sorted(r.doc_id for r in docs["tokens"]) == sorted(copies.elements())


def test_pre_tokens_are_the_librarys_ids_without_the_library():
    encoder, asked = tokens.Encoder(queries.BYTE_BPE, "<u2", True, False), []
    texts = ["Oianè### straße's çéüx 12 ª­\tx\n\n y", "naïve don't x ﬁ é́ x\x1fy", "日本語 ɐbc Ёж 𝒳", "", "a\x00b \x7f"]
    for text in texts:
        want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
        assert next(iter(encoder([text]))) == want, text
    whole = encoder.whole
    encoder.whole = lambda pieces: asked.extend(pieces) or whole(pieces)
    encoder.chunks.clear()
    encoder.pieces.clear()
    list(encoder(["Oianè### straße's çéüx 12"]))
    assert asked == []
    for chunk in (" ab's!", "foo''s", "é²x..", " ª##", "_a_", " ", "\t", "1.,"):
        assert tokens.pre_tokens(chunk) == tokens.PRE_TOKEN.findall(chunk)
