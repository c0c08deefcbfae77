"""The pipeline's stages on odd rows: nulls, repeated ids, rows without labels, clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from camadas.llm import quality, topk
from camadas.llm.common import unused, with_row_key
from camadas.llm.substrings import text_mark
from tests.llm.support import SF, odd_rows, prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row_key", "mix_copies", "mix_number", "quality_score", "kept_key", "mix_key", "shared_id", "mark", "a.b")


@pytest.fixture()
def folder(spark, tmp_path):
    """Tables without labels, and one benchmark item."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(900, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def wide(spark, rows):
    shape = DOCS + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, i) + tuple(f"{c}{i}" for c in CLASHES) for i, r in enumerate(rows)], shape)


def odd_corpus():
    rows = odd_rows() + [(42, prose(42, 50), "en", "a"), (None, None, "en", "b"), (None, prose(77, 50), None, "b")]
    rows += [(70, prose(71, 40), "en", "a"), (70, prose(72, 40), "en", "a"), (70, prose(71, 40), "en", "a")]
    return rows + [(80, prose(81, 40) + " " + prose(900, 30) + " " + prose(82, 40), "en", "b")]


def said(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_no_labels_reject_nothing(spark, folder):
    docs = wide(spark, odd_corpus())
    kept = corpus_pipeline.keep_quality(spark, docs, folder)
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, docs.collect()))


def test_quality_keeps_columns_of_its_own_name(spark):
    docs = wide(spark, odd_corpus())
    labels = spark.createDataFrame([(5, 1), (6, 0), (8, 1), (9, 0)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels, F.lit(False), -1.0)
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == Counter(map(tuple, docs.collect()))


def test_row_keys(spark):
    docs = wide(spark, odd_corpus())
    keyed = with_row_key(docs, "key").collect()
    by_key = {}
    for r in keyed:
        by_key.setdefault(r.key, set()).add((r.doc_id, r.text))
    assert len(keyed) == docs.count() and all(len(v) == 1 for v in by_key.values())
    once = Counter(i for i, _ in {(r[0], r[1]) for r in odd_corpus()})
    assert all(r.key == r.doc_id for r in keyed if once[r.doc_id] == 1 and r.doc_id is not None)
    assert unused("A.b", docs) == "A.b_"


def test_near_duplicates_lose_no_text_of_a_shared_id(spark, folder):
    docs = wide(spark, odd_corpus())
    got = said(corpus_pipeline.drop_near_duplicates(spark, docs, folder))
    want = Counter({(r[0], r[1]): 1 for r in odd_corpus()})
    copy = 2**60 + 1  # says what document 5 says
    del want[(copy, prose(5, 60))]
    assert got == want


def test_leaks_go_row_by_row(spark, folder):
    docs = wide(spark, odd_corpus())
    got = said(corpus_pipeline.drop_leaks(spark, docs, folder))
    assert got == Counter((r[0], r[1]) for r in odd_corpus() if r[0] != 80)


def test_all_stages_on_odd_rows_and_on_none(spark, folder):
    for docs in (wide(spark, odd_corpus()), wide(spark, odd_corpus()).limit(0)):
        columns, some = docs.columns, docs.count() > 0
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, folder), f"odd-{name}")
            assert name == "tokens" or docs.columns == columns
        assert (docs.count() > 0) == some


def test_mixture_copies_keep_their_columns(spark, folder):
    docs = wide(spark, odd_corpus())
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    rows = set(map(tuple, docs.collect()))
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= rows


# --- what the second round's review found in other operators ----------------------------------


def test_top_k_takes_large_components(spark):
    rows = [(i, [float(i) * 1e5, 2.5e6]) for i in range(12)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vectors, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    scores = {i: sum(int(a * 1024) * int(b * 1024) for a, b in zip(rows[0][1], v)) for i, v in rows[1:]}
    best = sorted(scores, key=lambda i: (-scores[i], i))[:3]
    assert [(r.vec_id, r.score) for r in got] == [(i, scores[i]) for i in best]


def test_top_k_with_many_rows_of_the_query_s_id(spark):
    rows = [(7, [1.0, 1.0])] * 16 + [(i, [0.5, i / 1000]) for i in range(100, 130)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vectors, F.col("vec_id") == 7, 10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(129, 119, -1))


def test_texts_of_one_id_lose_only_what_repeats(spark):
    """Marks of 17 bits took two different texts of an id for one; 63 bits tell these apart."""
    from camadas.llm.substrings import remove_repeats

    passage, seen, pair = prose(1, 60), {}, None
    for n in range(3000):
        text = prose(10_000 + n, 45)
        mark = text_mark(text.encode()) & 0xFFFF
        if mark in seen:
            pair = seen[mark], text
            break
        seen[mark] = text
    assert pair
    docs = spark.createDataFrame([(1, passage), (9, pair[0] + " " + passage), (9, pair[1])], "doc_id long, text string")
    lost = {r.n_bytes: r.n_removed for r in remove_repeats(docs).collect()}
    assert lost[len(passage)] == 0 and lost[len(pair[1])] == 0
    assert lost[len(pair[0]) + 1 + len(passage)] >= len(passage)
