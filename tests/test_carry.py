"""A second cycle that carries touched keys only: what it writes, and that a full run finds nothing left."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from camadas.entities import ENTITIES
from camadas.plans.bronze import run_bronze
from camadas.plans.carry import carry_changes
from camadas.plans.gold import run_gold
from camadas.plans.marts import in_months
from camadas.plans.silver import noted_changes, run_silver
from camadas.sources import landing
from tests.test_pipeline import DAY, Lake, files
from workload.shop import Shop


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    shop = Shop(spark, "/root/testdata/sf0.001")
    made = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    made.shop = shop
    made.run({n: shop[n] for n in ENTITIES})
    return made


def second(lake, sources):
    at = DAY + dt.timedelta(days=100)
    later = {n: f.withColumn("updated_at", F.expr("updated_at + interval 40 year")) for n, f in sources.items()}
    landing.extract(later, ENTITIES, lake.root, "shop", "next", at, {})
    run_bronze(lake.spark, lake.root, "shop", "next", at, at)
    run_silver(lake.spark, lake.root, "shop", "next", at, at)
    noted = noted_changes(lake.spark, lake.root, "shop")
    return noted, at, {r["table"]: r for r in carry_changes(lake.spark, lake.root, "shop", "next", at, at)}


def test_touched_keys_only(lake):
    assert noted_changes(lake.spark, lake.root, "shop") == []  # the full run has covered the first load
    before = set(files(f"{lake.root}/gold/shop"))
    sources = {
        "clientes": lake.shop["clientes"].filter("id_cliente = 7").withColumn("cidade", F.lit("Nova")),
        "categorias": lake.shop["categorias"].limit(1).withColumn("descricao", F.lit("outra")),
        "pedidos": lake.shop["pedidos"].filter("id_pedido = 11").withColumn("data_pedido", F.expr("data_pedido + 400")),
    }
    old_day, new_day = (f.filter("id_pedido = 11").first()["data_pedido"] for f in (lake.shop["pedidos"], sources["pedidos"]))
    items = lake.shop["itens_pedido"].filter("id_pedido = 11").count()
    noted, at, done = second(lake, sources)
    assert len(noted) == 3
    assert done["dim_cliente"]["records_modelled"] == done["dim_cliente"]["versions_inserted"] == 1
    products = lake.gold("dim_produto").filter("descricao_categoria = 'outra'")
    assert done["dim_produto"]["updated"] == products.count() > 0
    assert done["dim_cupom"]["status"] == "already_current" and done["dim_cupom"]["records_modelled"] == 0
    # items of the moved order change years; payments and deliveries of it are built again but are as before
    assert done["fato_vendas"]["records_modelled"] == done["fato_vendas"]["updated"] == items
    assert done["fato_pagamentos"]["rows_written"] == done["fato_entregas"]["rows_written"] == 0
    # reviews since the change take the new versions, older ones are not built again
    keys = [r["produto_key"] for r in products.select("produto_key").distinct().collect()]
    late = lake.shop["avaliacoes"].filter(F.col("data_avaliacao") >= F.lit(at).cast("date"))
    late = late.filter((F.col("id_cliente") == 7) | F.col("id_produto").isin(keys)).count()
    assert done["fato_avaliacoes"]["records_modelled"] == done["fato_avaliacoes"]["rows_written"] == late
    gone = {f.split("/gold/shop/")[1] for f in before - set(files(f"{lake.root}/gold/shop"))}
    years = {f.split("/ano=")[1][:4] for f in gone if f.startswith("fato_vendas/")}
    assert not any(f.startswith(("fato_pagamentos/", "fato_entregas/")) for f in gone)
    assert years == {str(old_day.year), str(new_day.year)}
    moved = lake.gold("fato_vendas").filter("id_pedido = 11")
    assert moved.count() == items and moved.select("ano").distinct().collect() == [(new_day.year,)]
    # nothing is left for a full run of the same instant, nor for another carry
    written = files(f"{lake.root}/gold/shop")
    full = run_gold(lake.spark, lake.root, "shop", "full", at, at)
    assert {r["status"] for r in full} == {"already_current"}
    again = carry_changes(lake.spark, lake.root, "shop", "again", at, at)
    assert {r["status"] for r in again} == {"already_current"} and written == files(f"{lake.root}/gold/shop")


def test_month_ranges(spark):
    days = spark.sql("select explode(sequence(date'1996-11-01', date'1998-03-31', interval 1 day)) as d")
    for months in (["1996-12"], ["1996-12", "1997-01", "1997-03"], ["1998-02", "1996-11"]):
        want = days.filter(F.date_format("d", "yyyy-MM").isin(months)).count()
        assert days.filter(in_months("d", months)).count() == want
