import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from camadas.contracts import Entity
from camadas.entities import ENTITIES
from camadas.sources import bronze, csv_files, landing, synthetic
from camadas.sources.tables import FolderTable, append, changed_parts, read_or_none, table_path
from tests.conftest import plan, rows

UTC = dt.timezone.utc


def test_instants():
    got = landing.parse_instant("2026-06-13T09:30:00-03:00")
    assert landing.format_instant(got) == "2026-06-13T12:30:00Z"
    assert landing.parse_instant("") is None
    assert landing.parse_instant("2026-06-13T00:00:00").tzinfo is UTC


def test_paths():
    assert landing.safe_component(" manual__2026-06-13T12:00:00+00:00 ") == "manual__2026-06-13T12_00_00_00_00"
    with pytest.raises(ValueError):
        landing.safe_component("  ")
    assert landing.batch_folder("/l/", "shop", "pedidos", dt.date(2026, 6, 13), "r:1") == (
        "/l/landing/shop/pedidos/extraction_date=2026-06-13/run_id=r_1")
    assert table_path("/l", "gold", "my shop", "t") == "/l/gold/my_shop/t"


def test_overlap(spark):
    stamps = [dt.datetime(2026, 6, d, h) for d, h in ((11, 0), (12, 11), (12, 12), (13, 12), (14, 0))]
    df = spark.createDataFrame([(s,) for s in stamps] + [(None,)], "updated_at timestamp")
    since = dt.datetime(2026, 6, 13, 12, tzinfo=UTC)
    assert landing.changed_since(df, since).count() == 3
    assert landing.changed_since(df, since, overlap_hours=0).count() == 2
    assert landing.changed_since(df, None).count() == 6
    ordered = landing.changed_since(df, since, ordered=True).collect()
    assert [r[0] for r in ordered] == sorted(r[0] for r in ordered)
    with pytest.raises(ValueError):
        landing.changed_since(df, since, overlap_hours=-1)


def test_overlap_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp '2026-06-13' as updated_at, 1 as x").write.parquet(path)
    df = landing.changed_since(spark.read.parquet(path), dt.datetime(2026, 6, 1, tzinfo=UTC))
    assert "GreaterThanOrEqual(updated_at" in plan(df)


def shop_rows(spark, *days):
    data = [(i, "n", "d", dt.datetime(2026, 6, d)) for i, d in enumerate(days, 1)]
    return spark.createDataFrame(data, "id_categoria bigint, nome_categoria string, descricao string, updated_at timestamp")


def test_extract_writes_files_and_advances(spark, tmp_path):
    run = dict(entities=ENTITIES, root=str(tmp_path), database="shop",
               logical_date=dt.datetime(2026, 6, 13, tzinfo=UTC))
    name = "categorias"
    results, marks = landing.extract({name: shop_rows(spark, 11, 13)}, run_id="a", checkpoints={}, **run)
    assert results[0]["document_count"] == 2 and results[0]["status"] == "written"
    assert marks[name] == dt.datetime(2026, 6, 13, tzinfo=UTC)
    files = os.listdir(results[0]["folder"])
    assert any(f.endswith(".json") for f in files)

    # the overlap re-reads the last day, an empty batch leaves no file
    results, marks = landing.extract({name: shop_rows(spark, 12)}, run_id="b", checkpoints=marks, **run)
    assert results[0]["document_count"] == 1 and marks[name] == dt.datetime(2026, 6, 12, tzinfo=UTC)
    newer = {name: dt.datetime(2026, 6, 13, tzinfo=UTC)}
    _, marks = landing.extract({name: shop_rows(spark, 12)}, run_id="c", checkpoints=newer, monotonic=True, **run)
    assert marks == newer
    results, marks = landing.extract({name: shop_rows(spark, 1)}, run_id="d", checkpoints=newer, **run)
    assert results[0]["status"] == "no_changes" and marks == newer
    assert not os.path.exists(results[0]["folder"])


def test_folder_table_replaces_only_named_partitions(spark, tmp_path):
    t = FolderTable(spark, str(tmp_path / "t"), "ano")
    assert not t.exists()
    with pytest.raises(LookupError):
        t.read()
    t.rewrite(spark.range(30).selectExpr("id", "nullif(id % 3 + 2020, 2022) as ano"))
    before = sorted(os.listdir(tmp_path / "t/ano=2020"))
    t.rewrite(spark.sql("select 100L as id, 2021L as ano"), [2021, None])
    assert rows(t.read().groupBy("ano").count()) == [(2020, 10), (2021, 1)]
    assert sorted(os.listdir(tmp_path / "t/ano=2020")) == before
    t.rewrite(t.read().filter(t.inside([2021])).selectExpr("id + 1 as id", "ano"), [2021])
    assert rows(t.read().filter("ano = 2021")) == [(101, 2021)]


def test_changed_parts_names_old_and_new_side(spark):
    actions = spark.createDataFrame(
        [("updated", 1, 2), ("unchanged", 3, 3), ("deleted", 4, None), ("inserted", None, 5), ("updated", None, 1)],
        "_action string, _old_ano int, _new_ano int")
    assert sorted(changed_parts(actions, "ano"), key=str) == [1, 2, 4, 5, None]


def test_append_allows_new_columns(spark, tmp_path):
    path = str(tmp_path / "b")
    assert read_or_none(spark, path) is None
    append(spark.sql("select 1 as a, date '2024-01-01' as d"), path, ["d"])
    append(spark.sql("select 2 as a, 'x' as b, date '2024-01-02' as d"), path, ["d"])
    assert rows(read_or_none(spark, path, mergeSchema="true"), "a", "b") == [(1, None), (2, "x")]


def test_lineage_of_odd_paths(spark):
    df = spark.createDataFrame(
        [("s3a://l/landing/s/c/extraction_date=2026-06-13/run_id=r_1/part-00000.json",), ("/x/y.json",),
         ("/x/extraction_date=soon/run_id=r/y.json",)], "p string")
    assert rows(df.select(*bronze.path_lineage(F.col("p")))) == [
        (None, ""), (None, "r"), (dt.date(2026, 6, 13), "r_1")]


def test_csv_round_trip(spark, tmp_path):
    entity = ENTITIES["pedidos"]
    path = tmp_path / "pedidos.csv"
    path.write_text(
        "id_pedido,id_cliente,data_pedido,status,valor_total,id_cupom,updated_at\n"
        "1,2,2024-01-02T00:00:00,entregue,10.5,311.0,2024-01-03\n"
        "x,,bad,,n/a,,\n")
    got = csv_files.read_typed(spark, str(path), entity).collect()
    assert got[0].id_cupom == 311 and got[0].valor_total == 10.5
    assert got[0].data_pedido == dt.datetime(2024, 1, 2)
    assert all(v is None for v in got[1])
    df = spark.range(100)
    csv_files.write(df.repartition(4), str(tmp_path / "many"))
    csv_files.write(df.repartition(4), str(tmp_path / "one"), single_file=True)
    parts = {n: len([f for f in os.listdir(tmp_path / n) if f.endswith(".csv")]) for n in ("many", "one")}
    assert parts == {"many": 4, "one": 1}
    assert spark.read.csv(str(tmp_path / "many"), header=True).count() == 100


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    ids = spark.range(1, 3001)
    one = synthetic.orders(ids.repartition(1), 100, 10)
    many = synthetic.orders(ids.repartition(7), 100, 10)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_synthetic_distributions(spark):
    ids, n = spark.range(1, 5001), 5000
    o = synthetic.orders(ids, 100, 10).cache()
    share = {r.status: r["count"] / n for r in o.groupBy("status").count().collect()}
    assert abs(share["entregue"] - 0.55) < 0.03 and abs(share["pendente"] - 0.05) < 0.02
    assert abs(o.filter("id_cupom is not null").count() / n - 0.25) < 0.03
    assert o.filter("updated_at < data_pedido or valor_total not between 20 and 3000").count() == 0
    p = synthetic.payments(ids, 100)
    assert p.filter("forma_pagamento <> 'cartao_credito' and parcelas <> 1").count() == 0
    d = synthetic.deliveries(ids, 100)
    bad = "(data_entrega_real is not null) <> (status_entrega in ('entregue', 'devolvido'))"
    assert d.filter(bad).count() == 0
    assert d.filter("not codigo_rastreio rlike '^[A-Z]{2}[0-9]{9}BR$'").count() == 0
    r = synthetic.reviews(ids, 100, 100, 100)
    assert r.filter("nota not between 1 and 5 or comentario is null").count() == 0
    i = synthetic.order_items(ids, 100, 100)
    assert i.filter("subtotal > quantidade * valor_unitario or subtotal <= 0").count() == 0


def test_compressed_landing_and_csv_files_are_read_like_plain_ones(spark, tmp_path):
    rows, rule = shop_rows(spark, *range(1, 20)), ENTITIES["categorias"]
    for form in (None, "gzip"):
        folder = landing.batch_folder(str(tmp_path), "shop", rule.name, dt.date(2026, 6, 13), f"run-{form}")
        assert landing.write_batch(rows, rule, folder, compression=form)["document_count"] == 19
    assert bronze.scan(spark, str(tmp_path)).count() == 38 and bronze.landing_files(spark, str(tmp_path)).count() >= 2
    csv_files.write(rows, f"{tmp_path}/c.csv", compression="gzip")
    assert any(f.endswith(".csv.gz") for f in os.listdir(f"{tmp_path}/c.csv"))
    assert csv_files.read_typed(spark, f"{tmp_path}/c.csv", rule).count() == 19
