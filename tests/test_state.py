"""Keyed state, the plans that keep it current batch by batch, and the streams that merge into it."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camadas import session
from camadas.entities import ENTITIES, WATERMARK
from camadas.functions.extjson import encode
from camadas.operators import history, upsert
from camadas.plans import silver
from camadas.plans.bronze import FileLedger, ingest, pending_lines
from camadas.plans.increments import ParkedReferences, UniqueSilver
from camadas.sources import bronze, landing
from camadas.sources import state as state_module
from camadas.sources.state import Journal, KeyedState
from camadas.sources.tables import FolderTable
from camadas.streaming import merge
from camadas.streaming.ingest import landing_stream
from tests.conftest import plan, rows
from workload.shop import Shop

UTC = dt.timezone.utc
AT = dt.datetime(2002, 1, 1, tzinfo=UTC)
SHAPE = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType()), T.StructField("h", T.StringType())])


def folders(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_state_replaces_the_buckets_it_must(spark, tmp_path):
    path = str(tmp_path / "s")
    state = KeyedState(spark, path, "id", SHAPE, 8)
    assert state.read().count() == 0
    state.change(spark.range(100).selectExpr("id", "1L as v", "'a' as h"))
    before = folders(path)
    assert len(before) == 8
    hit = state.change(spark.sql("select 7L as id, 2L as v, 'b' as h"))
    after = folders(path)
    assert len(hit) == 1 and [b for b in before if before[b] != after[b]] == [f"_bucket={hit[0]}"]
    assert rows(state.read().filter("v = 2")) == [(7, 2, "b")] and state.read().count() == 100
    state.change(spark.range(0).selectExpr("id", "1L as v", "'a' as h"), state.rows([hit[0]]).select("id"))
    assert state.rows([hit[0]]).count() == 0 and f"_bucket={hit[0]}" not in folders(path)


def test_merge_does_not_move_the_state(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), "id", SHAPE, 8)
    state.change(spark.range(100).selectExpr("id", "5L as v", "'a' as h"))
    batch = spark.sql("select * from values (1L, 4L, 'z'), (2L, 5L, 'a'), (3L, 5L, 'b'), (4L, 6L, 'a'), (500L, 1L, 'q') as t(id, v, h)")
    counts = upsert.merge_into(state, batch, "v", "h")
    assert counts == {"inserted": 1, "updated": 2, "unchanged": 2, "rows_written": 3}
    assert rows(state.read().filter("id < 5 or id > 99")) == sorted(
        [(0, 5, "a"), (1, 5, "a"), (2, 5, "a"), (3, 5, "b"), (4, 6, "a"), (500, 1, "q")], key=str)
    before = folders(state.path)
    assert upsert.merge_into(state, batch, "v", "h")["rows_written"] == 0 and folders(state.path) == before
    text = plan(state.matching(batch, 5, "v"))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning(id") <= 1


def test_journal_completes_what_a_dead_run_left(spark, tmp_path):
    seen = []
    journal = Journal(spark, str(tmp_path / "j"), lambda frames: seen.append(sorted(r[0] for r in frames["a"].collect())))
    journal.put(a=spark.range(2))
    spark.range(3).write.parquet(str(tmp_path / "j/a"))
    journal.complete()  # not ready: the run died before it had decided
    assert seen == [[0, 1]]
    spark.range(1).write.parquet(str(tmp_path / "j/_ready"))
    journal.complete()
    journal.complete()
    assert seen == [[0, 1], [0, 1, 2]]


def full_run(spark, lines, entity):
    newest = silver.candidates(lines, entity, "r", AT)
    from camadas.operators import quality

    judged = quality.assess(newest, entity, {}, silver.NEWEST)
    return rows(judged.filter("_status = 'valid'").select(*entity.columns))


def customer_lines(spark, specs, name, hour):
    """(id, cpf, day, good) as raw lines of one file."""
    shape = "id_cliente long, cpf string, day int, ok boolean"
    made = spark.createDataFrame(specs, shape)
    known = {"nome": "'n'", "email": "if(ok, 'a@b.c', 'x')", "telefone": "'5511999990000'", "data_nascimento": "date '1990-01-01'",
             "genero": "'M'", "logradouro": "'l'", "cidade": "'c'", "estado": "'SP'", "cep": "'00000000'",
             "data_cadastro": "date '2000-01-01'", "updated_at": "timestamp '2000-01-01' + make_dt_interval(day)"}
    typed = made.selectExpr("id_cliente", "cpf", *(f"{e} as {c}" for c, e in known.items()))
    return encode(typed, ENTITIES["clientes"]).select(
        "raw_document", F.lit(name).alias(bronze.SOURCE_FILE),
        F.lit(AT + dt.timedelta(hours=hour)).alias(bronze.INGESTED_AT))


@pytest.mark.parametrize("seed", [0, 1])
def test_incremental_uniqueness_equals_a_full_run(spark, tmp_path, seed):
    """Few values, so that winners change hands, leave, come back, turn invalid and tie."""
    rng, entity = random.Random(seed), ENTITIES["clientes"]
    table, lines = UniqueSilver(spark, str(tmp_path / "u"), entity, 4), None
    searched = 0
    for n in range(4):
        specs = [(rng.randint(1, 14), f"{rng.randint(1, 4):011d}", rng.randint(0, 6), rng.random() < 0.8) for _ in range(9)]
        batch = customer_lines(spark, specs, f"f{n}", n)
        lines = batch if lines is None else lines.unionByName(batch)
        searched += table.add(batch)["searched"]
        assert rows(table.read()) == full_run(spark, lines, entity)
    before = folders(table.candidates.path)
    assert table.add(batch)["changed"] == 0 and folders(table.candidates.path) == before


def test_winner_that_leaves_is_followed(spark, tmp_path):
    entity = ENTITIES["clientes"]
    table = UniqueSilver(spark, str(tmp_path / "u"), entity, 4)
    table.add(customer_lines(spark, [(1, "00000000001", 1, True), (2, "00000000001", 2, True), (3, "00000000001", 3, True)], "a", 0))
    assert [r.id_cliente for r in table.read().collect()] == [3]
    done = table.add(customer_lines(spark, [(3, "00000000009", 4, True)], "b", 1))
    assert done == {"changed": 1, "searched": 1, "flipped": 1}
    assert sorted(r.id_cliente for r in table.read().collect()) == [2, 3]
    done = table.add(customer_lines(spark, [(2, "00000000001", 5, False)], "c", 2))
    assert done["searched"] == 1 and sorted(r.id_cliente for r in table.read().collect()) == [1, 3]


def test_late_parents_release_parked_children(spark, tmp_path):
    shop, entity = Shop(spark, "/root/testdata/sf0.001"), ENTITIES["pedidos"]
    table = ParkedReferences(spark, str(tmp_path / "p"), entity, 4)
    clients, coupons = shop["clientes"], shop["cupons"]
    first = table.add(shop["pedidos"], {"clientes": clients.filter("id_cliente % 2 = 0"), "cupons": coupons.filter("id_cupom % 2 = 0")})
    assert first["curated"] > 0 and first["parked"] > 0
    assert table.new_parents({"clientes": clients.filter("id_cliente % 2 = 1")})["parked"] > 0  # some still lack a coupon
    table.new_parents({"cupons": coupons.filter("id_cupom % 2 = 1")})
    assert table.parked.read().count() == 0
    assert rows(table.curated.read(), *entity.columns) == rows(shop["pedidos"], *entity.columns)
    assert table.new_parents({"cupons": coupons}) == {"curated": 0, "parked": 0}


def test_pending_files_do_not_read_raw_rows(spark, tmp_path):
    shop, root = Shop(spark, "/root/testdata/sf0.001"), str(tmp_path)
    for i, day in enumerate((AT, AT + dt.timedelta(days=1))):
        folder = landing.batch_folder(root, "shop", "pedidos", day.date(), f"b{i}")
        landing.write_batch(shop["pedidos"].filter(f"id_pedido % 2 = {i}"), ENTITIES["pedidos"], folder)
        assert ingest(spark, root, "shop", "pedidos", f"r{i}", day, day)["status"] == "written"
    ledger = FileLedger(spark, root, "shop", "pedidos")
    listing = f"{root}/landing/shop/pedidos"
    text = plan(ledger.pending(listing))
    assert "/bronze/shop" not in text and "PartitionFilters: [extraction_day" in text.replace("isnotnull(extraction_day#", "extraction_day#")
    assert pending_lines(ledger, listing) is None
    assert ledger.known([AT.date().isoformat()]).count() < ledger.known(["2002-01-01", "2002-01-02"]).count()


def sink(spark, tmp_path, name="pedidos"):
    return merge.MergeSink(merge.state_of(spark, str(tmp_path / name), ENTITIES["pedidos"], 4), ENTITIES["pedidos"], name)


def test_a_repeated_batch_is_passed_over(spark, tmp_path):
    shop, to = Shop(spark, "/root/testdata/sf0.001"), sink(spark, tmp_path)
    lines = encode(shop["pedidos"], ENTITIES["pedidos"]).select("raw_document", F.lit("f").alias(bronze.SOURCE_FILE))
    batch = merge.valid_rows(lines, ENTITIES["pedidos"])
    to(batch, 0)
    later = batch.withColumn("status", F.lit("cancelado")).withColumn(WATERMARK, F.col(WATERMARK) + F.expr("interval 1 day"))
    to(later, 0)
    assert to.state.read().filter("status <> 'cancelado'").count() > 0
    to(later, 1)
    assert to.state.read().filter("status <> 'cancelado'").count() == 0
    to(batch, 2)  # late: older than what is there
    assert to.state.read().filter("status <> 'cancelado'").count() == 0
    assert to.applied(spark).agg(F.sum("rows_written")).first()[0] == 2 * batch.count()


def test_stream_dedup_passes_each_version_once_and_loses_nothing(spark, tmp_path):
    shop, to, root = Shop(spark, "/root/testdata/sf0.001"), sink(spark, tmp_path), str(tmp_path)
    total = shop["pedidos"].count()
    for i, where in enumerate(("id_pedido % 2 = 0 and updated_at > '1999-01-01'", "true", "id_pedido % 3 = 0")):
        folder = landing.batch_folder(root, "shop", "pedidos", AT.date(), f"b{i}")
        landing.write_batch(shop["pedidos"].filter(where), ENTITIES["pedidos"], folder)
        query = merge.merge_unseen(spark, f"{root}/landing/shop/pedidos", to, f"{root}/cp")
        assert query.awaitTermination(120)
    counts = to.applied(spark).agg(F.sum("inserted"), F.sum("updated"), F.sum("unchanged")).first()
    assert tuple(counts) == (total, 0, 0)  # repeats were taken out before the merge
    assert to.state.read().count() == total


def test_keys_of_a_group_are_told_apart_in_one_call(spark, tmp_path):
    """Newer, older, equal and equal versions with other content, in three triggers of one group of keys."""
    root, rule = str(tmp_path), ENTITIES["pedidos"]
    base = Shop(spark, "/root/testdata/sf0.001")["pedidos"].filter("id_pedido <= 40")
    second = base.filter("id_pedido % 4 > 0").withColumn("status", F.expr("if(id_pedido % 4 = 3, status, 'cancelado')")).withColumn(
        WATERMARK, F.expr(f"{WATERMARK} + make_dt_interval(case id_pedido % 4 when 1 then 1 when 2 then -1 else 0 end)"))
    third = base.filter("id_pedido % 4 = 0").withColumn("status", F.lit("cancelado"))
    got, calls = [], []

    def take(batch, number):
        calls.append(number)
        got.append(sorted(r[0] for r in batch.select("id_pedido").collect()))

    ids = sorted(r[0] for r in base.select("id_pedido").collect())
    for i, rows_ in enumerate((base, second, third)):
        landing.write_batch(rows_, rule, landing.batch_folder(root, "shop", "pedidos", AT.date(), f"g{i}"), compression="gzip")
        found = merge.unseen_versions(merge.valid_rows(landing_stream(spark, f"{root}/landing/shop/pedidos"), rule), rule, groups=2)
        spark.conf.set(merge.EMPTY_BATCHES, "false")
        found.writeStream.foreachBatch(take).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination(120)
        spark.conf.unset(merge.EMPTY_BATCHES)
    changed = [i for i in ids if i % 4 == 0 and base.filter(f"id_pedido = {i} and status <> 'cancelado'").count()]
    assert got == [ids, [i for i in ids if i % 4 == 1], changed]


def test_tables_are_replaced_from_themselves_without_a_copy(spark, tmp_path, monkeypatch):
    copies = []
    monkeypatch.setattr(session, "scratch_dir", lambda s, label: copies.append(label) or str(tmp_path / f"{label}{len(copies)}"))
    state = KeyedState(spark, str(tmp_path / "state"), "k", buckets=4)
    state.change(spark.range(100).selectExpr("id as k", "'a' as v"))
    state.change(spark.range(10).selectExpr("id as k", "'b' as v"), spark.range(90, 100).selectExpr("id as k"))
    assert {r.v: r.n for r in state.read().groupBy("v").agg(F.count("k").alias("n")).collect()} == {"a": 80, "b": 10}
    state.change(spark.range(0).selectExpr("id as k", "'c' as v"), state.read().select("k"))
    assert not [f for f in os.listdir(state.path) if f.startswith("_bucket")]
    table = FolderTable(spark, str(tmp_path / "years"), "y")
    table.rewrite(spark.range(30).selectExpr("id as k", "if(id % 3 = 0, null, cast(id % 3 as int)) as y"))
    table.rewrite(table.read().filter("y = 2"), [1, 2, None])
    assert table.read().count() == 10 and copies == []


def test_more_rows_than_may_be_broadcast_go_in_lots_of_buckets(spark, tmp_path, monkeypatch):
    for module in (state_module, upsert):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 30)
    state, put = KeyedState(spark, str(tmp_path / "s"), "id", SHAPE, 8), []
    monkeypatch.setattr(KeyedState, "_put", lambda self, *a, call=KeyedState._put: put.append(a[3]) or call(self, *a))
    state.change(spark.range(100).selectExpr("id", "5L as v", "'a' as h"))
    assert put == [100]
    batch = spark.range(50, 150).selectExpr("id", "if(id % 2 = 0, 6L, 4L) as v", "'b' as h")
    counts = upsert.merge_into(state, batch, "v", "h")
    assert counts == {"inserted": 50, "updated": 25, "unchanged": 25, "rows_written": 75}
    assert len(put) > 3 and sum(put[1:]) == 75 and max(put[1:]) <= 30
    want = sorted((i, 6 if i >= 50 and i % 2 == 0 else 4 if i >= 100 else 5, "b" if i >= 100 or i >= 50 and i % 2 == 0 else "a")
                  for i in range(150))
    assert sorted(map(tuple, state.read().select("id", "v", "h").collect())) == want
    frames = state.matching_lots(batch.select("id"), 100, "v")
    assert len(frames) > 1 and sorted(r.id for f in frames for r in f.collect()) == list(range(50, 150))
    assert all("BroadcastHashJoin" in plan(f) for f in frames)
    state.change(batch.filter("id < 60"), spark.range(60, 140).select("id"))
    assert sorted(r.id for r in state.read().collect()) == [*range(60), *range(140, 150)]


@pytest.mark.parametrize("limit", [10**6, 1])
def test_put_rows_changes_only_named_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", limit)
    old = spark.sql("select * from values (1L, 1, 'a'), (2L, 1, 'b'), (3L, 1, 'c'), (4L, 1, 'd') as t(k, run, h)")
    new = spark.sql("select * from values (2L, 2, 'b'), (3L, 2, 'x'), (5L, 2, 'e') as t(k, run, h)")
    named = spark.sql("select * from values (2L), (3L), (4L), (5L), (6L) as t(k)")
    got = upsert.put_rows(old, new, named, 5, "k", "h")
    assert rows(got) == [(1, 1, "a"), (2, 1, "b"), (3, 2, "x"), (5, 2, "e")]
    assert limit > 1 or "LeftAnti" not in plan(got)  # the target is moved once, not for each kind of row


def versions_of(spark, keys, n):
    """n versions a key of ten days each, with a gap at every seventh."""
    made = spark.range(keys * n).selectExpr(f"id div {n} as k", f"id % {n} as i").filter("i % 7 <> 3")
    start = "timestamp '2000-01-01' + make_dt_interval(cast(i * 10 as int))"
    return made.selectExpr("k as cliente_key", "concat(k, '-', i) as cliente_sk", f"{start} as dw_valid_from",
                           f"{start} + interval 10 days as dw_valid_to")


@pytest.mark.parametrize("hot_events", [10**6, 200])
def test_lookup_by_merge_with_many_versions(spark, hot_events):
    dim = versions_of(spark, 3, 1000)
    fact = spark.range(3000).selectExpr(
        "id as venda_key", "case when id % 11 = 0 then null when id % 3 > 0 then 1L else id % 5 end as cliente_key",
        "case when id % 13 = 0 then null else timestamp '1999-12-01' + make_dt_interval(cast(id * 3.5 as int), 0, 0, id % 2) end as quando")
    fact = fact.unionByName(fact.filter("venda_key < 50"))
    args = (fact, dim, "cliente_key", "cliente_sk", "quando")
    assert rows(history.lookup_by_merge(*args, hot_events)) == rows(history.lookup_as_of(*args, "venda_key"))


def test_backdated_changes_leave_no_gap_and_no_overlap(spark):
    rng = random.Random(3)
    when = lambda d: dt.datetime(2000, 1, 1) + dt.timedelta(days=d)

    def hashed(specs):
        made = spark.createDataFrame(specs, "k long, cidade string, desde timestamp")
        return made.withColumn(history.VERSION_HASH, F.sha2("cidade", 256))

    first = hashed([(k, "a", when(0)) for k in range(20)]).drop("desde")
    state = history.first_versions(first, "k", "k_sk")
    for _ in range(3):
        changes = [(rng.randint(0, 24), rng.choice("abc"), when(rng.randint(0, 9))) for _ in range(25)]
        state = history.apply_backdated(state, hashed(changes), "k", "k_sk", "desde").drop("_scd_action")
        state = spark.createDataFrame(state.collect(), state.schema)
        by_key = {}
        for r in state.collect():
            by_key.setdefault(r.k, []).append(r)
        for versions in by_key.values():
            versions.sort(key=lambda r: r.dw_valid_from)
            assert versions[0].dw_valid_from == dt.datetime(1900, 1, 1)
            assert all(a.dw_valid_to == b.dw_valid_from for a, b in zip(versions, versions[1:]))
            assert [r.dw_is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        assert state.select("k_sk").distinct().count() == state.count()
        for k, said, at in changes:  # the last word at its instant, unless another was said then
            others = {s for q, s, t in changes if (q, t) == (k, at)}
            held = [r for r in by_key[k] if r.dw_valid_from <= at < r.dw_valid_to]
            assert held[0].cidade in others
