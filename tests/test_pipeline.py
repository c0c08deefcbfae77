"""Landing to Gold on a small shop: load, re-run, change, late and equal versions, deletion."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from camadas.entities import ENTITIES, MODELS
from camadas.plans.bronze import run_bronze
from camadas.plans.export import export_star
from camadas.plans.extract import load_checkpoints, run_extract
from camadas.plans.gold import build, gold_table, run_gold
from camadas.plans.silver import BUCKETS, read_silver, run_silver
from camadas.sources import csv_files, landing
from workload.shop import Shop

UTC = dt.timezone.utc
DAY = dt.datetime(2002, 1, 1, tzinfo=UTC)


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root, self.n, self.marks = spark, root, 0, {}

    def run(self, sources, tables=None, models=None):
        """One cycle over the given source frames, through all tables or the named ones."""
        self.n += 1
        at = DAY + dt.timedelta(days=self.n)
        rid = f"run{self.n}"
        landing.extract(sources, ENTITIES, self.root, "shop", rid, at, {})
        b = run_bronze(self.spark, self.root, "shop", rid, at, at, tables)
        s = run_silver(self.spark, self.root, "shop", rid, at, at, tables)
        g = run_gold(self.spark, self.root, "shop", rid, at, at, models)
        return ({r["table"]: r for r in part} for part in (b, s, g))

    def silver(self, name):
        return read_silver(self.spark, self.root, "shop", name)

    def gold(self, name):
        return gold_table(self.spark, self.root, "shop", MODELS[name]).read()


def files(root):
    """All Parquet files below a folder."""
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    shop = Shop(spark, "/root/testdata/sf0.001")
    made = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    made.shop = shop
    made.first = list(made.run({n: shop[n] for n in ENTITIES}))
    return made


def test_first_load(lake):
    b, s, g = lake.first
    assert {r["status"] for r in b.values()} == {"written"}
    for name, r in s.items():
        assert r["records_read"] == r["duplicates_removed"] + r["records_rejected"] + r["records_valid"]
        assert r["inserted"] == r["records_valid"] == lake.silver(name).count()
    # one of two approved payments per tenth order is a business reject, and is logged
    assert s["pagamentos"]["business_rule_rejected"] == 150
    log = lake.spark.read.parquet(f"{lake.root}/silver/_control/quality_log")
    assert log.filter("tabela = 'pagamentos'").count() == 150
    assert set(log.columns) == {
        "run_id", "dag_id", "tabela", "chave_primaria", "tipo_rejeicao", "detalhe", "hash_registro",
        "rejeitado_em"}
    assert s["clientes"]["records_valid"] == 150 and g["dim_cliente"]["versions_inserted"] == 150
    assert g["fato_vendas"]["records_modelled"] == lake.gold("fato_vendas").count()
    sales = lake.gold("fato_vendas")
    assert sales.filter("cliente_sk is null or produto_sk is null").count() == 0
    assert sales.filter("(cupom_key is null) <> (cupom_sk is null)").count() == 0
    assert sales.count() == s["itens_pedido"]["records_valid"]


def test_manifests(lake):
    for layer, job, counter in (("bronze", "landing_to_bronze", "rows_written"),
                                ("silver", "bronze_to_silver", "records_read"),
                                ("gold", "silver_to_gold", "records_modelled")):
        folder = f"{lake.root}/{layer}/_control/{job}/processing_date=2002-01-02/run_id=run1"
        part = next(f for f in os.listdir(folder) if f.endswith(".json"))
        doc = json.loads(open(f"{folder}/{part}").read())
        assert doc["run_id"] == "run1" and doc["logical_date"] == "2002-01-02T00:00:00Z"
        assert doc["totals"][counter] == sum(t[counter] for t in doc["tables"])
        names = [t["table"] for t in doc["tables"]]
        assert names == (list(MODELS) if layer == "gold" else sorted(ENTITIES))


def test_rerun_then_changes(lake):
    shop, spark = lake.shop, lake.spark
    before = files(f"{lake.root}/silver/shop") + files(f"{lake.root}/gold/shop")
    # nothing new has landed: no layer writes anything
    b, s, g = lake.run({})
    assert {r["status"] for r in b.values()} == {"already_processed"}
    assert {r["status"] for r in s.values()} == {"already_current"}
    assert {r["status"] for r in g.values()} == {"already_current"}
    assert all(r["unchanged"] == r["records_valid"] for r in s.values())
    assert before == files(f"{lake.root}/silver/shop") + files(f"{lake.root}/gold/shop")

    # a run repeated under its own id leaves the quality log as it was
    def log():
        return spark.read.parquet(f"{lake.root}/silver/_control/quality_log").collect()

    entries, rid = len(log()), f"run{lake.n}"
    at = DAY + dt.timedelta(days=lake.n)
    run_silver(spark, lake.root, "shop", rid, at, at)
    assert len(log()) == entries
    # a narrowed read must not miss the rows a table's rules compare with
    narrowed = run_silver(spark, lake.root, "shop", rid, at, at, since=dt.date(2999, 1, 1))
    assert {r["table"]: r["business_rule_rejected"] for r in narrowed} == {
        n: r["business_rule_rejected"] for n, r in s.items()}

    # three moved customers, one late older version, one equal version with other content, two new
    c = shop["clientes"]
    later = F.col("updated_at") + F.expr("interval 400 days")
    moved = c.filter("id_cliente in (1, 2, 3)").withColumn("cidade", F.lit("LUA")).withColumn("updated_at", later)
    late = c.filter("id_cliente = 4").withColumn("cidade", F.lit("ATRASO")).withColumn(
        "updated_at", F.col("updated_at") - F.expr("interval 1 day"))
    new = c.filter("id_cliente in (5, 6)").withColumns({
        "id_cliente": F.col("id_cliente") + 5000, "cpf": F.lpad((F.col("id_cliente") + 5000).cast("string"), 11, "0")})
    batch = moved.unionByName(late).unionByName(new)
    b, s, g = lake.run({"clientes": batch}, "clientes", "dim_cliente,fato_vendas")
    assert b["clientes"]["rows_written"] == 6
    assert (s["clientes"]["inserted"], s["clientes"]["updated"], s["clientes"]["unchanged"]) == (2, 3, 147)
    assert lake.silver("clientes").filter("cidade = 'ATRASO'").count() == 0
    dim = g["dim_cliente"]
    assert (dim["inserted"], dim["updated"], dim["versions_inserted"], dim["rows_written"]) == (2, 3, 5, 8)
    table = lake.gold("dim_cliente")
    assert table.filter("dw_is_current").count() == 152
    assert table.filter("dw_is_current").select("cliente_key").distinct().count() == 152
    overlap = table.alias("a").join(table.alias("b"), F.expr(
        "a.cliente_key = b.cliente_key and a.cliente_sk < b.cliente_sk"
        " and a.dw_valid_from < b.dw_valid_to and b.dw_valid_from < a.dw_valid_to"))
    assert overlap.count() == 0
    assert table.filter("not dw_is_current").count() == 3
    # facts older than the change still point at the first version
    assert g["fato_vendas"]["status"] == "already_current"

    equal = c.filter("id_cliente = 7").withColumn("cidade", F.lit("SOL"))
    _, s, _ = lake.run({"clientes": equal}, "clientes", "dim_cliente")
    # same timestamp: the later file wins the de-duplication, and the content differs
    assert s["clientes"]["updated"] == 1


def test_fact_rows_follow_their_source(lake, spark):
    """A vanished header removes its lines, and only the touched years are rewritten."""
    silver = {n: lake.silver(n) for n in ENTITIES}
    model = MODELS["fato_pagamentos"]
    store = gold_table(spark, lake.root, "shop", model)
    gone = silver["pedidos"].filter("year(data_pedido) <> 1996")
    years_hit = silver["pagamentos"].join(
        silver["pedidos"].filter("year(data_pedido) = 1996"), "id_pedido"
    ).selectExpr("year(data_pagamento) as ano").distinct().count()
    want = silver["pagamentos"].join(gone, "id_pedido", "left_semi").count()
    old, before = store.read().count(), files(store.path)
    r = build(spark, lake.root, "shop", model, {**silver, "pedidos": gone}, "x", DAY)
    assert r["deleted"] == old - want and r["inserted"] == r["updated"] == 0
    assert store.read().count() == want
    written = {os.path.dirname(f) for f in files(store.path) if f not in before}
    assert 0 < len(written) <= years_hit
    with pytest.raises(ValueError):
        build(spark, lake.root, "shop", model, {**silver, "pedidos": gone.limit(0)}, "x", DAY)


def test_one_changed_row_rewrites_one_bucket(spark, lake, tmp_path):
    root, name = str(tmp_path), "categorias"
    rows = spark.range(1, 1001).selectExpr(
        "id as id_categoria", "concat('n', id) as nome_categoria", "'d' as descricao",
        "timestamp '2001-01-01' as updated_at")
    changed = rows.filter("id_categoria = 150").withColumn("updated_at", F.expr("timestamp '2001-02-01'"))
    seen = []
    for i, batch in enumerate((rows, changed, None), 1):
        at = DAY + dt.timedelta(days=i)
        if batch is not None:
            landing.extract({name: batch}, ENTITIES, root, "shop", f"r{i}", at, {})
        run_bronze(spark, root, "shop", f"r{i}", at, at, name)
        got = run_silver(spark, root, "shop", f"r{i}", at, at, name)[0]
        seen.append(set(files(f"{root}/silver/shop/{name}")))
        if i == 2:
            assert (got["inserted"], got["updated"], got["unchanged"]) == (0, 1, 999)
    assert got["status"] == "already_current" and seen[1] == seen[2]
    assert len({os.path.dirname(f) for f in seen[1] - seen[0]}) == 1
    assert len({os.path.dirname(f) for f in seen[0]}) == BUCKETS
    state = read_silver(spark, root, "shop", name)
    assert state.count() == 1000 and state.filter("updated_at > '2001-01-15'").count() == 1


def test_scratch_tables_are_removed(spark, lake):
    left = [d for d in os.listdir(spark.conf.get("spark.checkpoint.dir")) if d.startswith(("newest", "judged", "model", "merge", "state", "rewrite", "versions"))]
    assert left == []


def test_checkpoints_move_last(spark, lake, tmp_path):
    root, name = str(tmp_path), "categorias"
    src = {name: lake.shop[name]}
    first = run_extract(spark, src, root, "shop", "a", DAY)
    assert first[0]["document_count"] == 6
    mark = load_checkpoints(spark, root, "shop")
    assert mark == {name: dt.datetime(1995, 1, 1, tzinfo=UTC)}
    broken = {name: lake.shop[name].withColumn("descricao", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        run_extract(spark, broken, root, "shop", "b", DAY)
    assert load_checkpoints(spark, root, "shop") == mark
    old = {name: lake.shop[name].withColumn("updated_at", F.expr("timestamp '1990-01-01'"))}
    assert run_extract(spark, old, root, "shop", "c", DAY)[0]["status"] == "no_changes"
    assert load_checkpoints(spark, root, "shop") == mark


def test_new_files_in_an_ingested_folder(spark, lake, tmp_path):
    """The ledger goes by file: a folder may gain files after it was read, old ones stay out."""
    root, name = str(tmp_path), "categorias"
    folder = landing.batch_folder(root, "shop", name, DAY.date(), "a")
    rows = lake.shop[name]
    for i in (1, 2):
        landing.wrapped(rows.limit(i), ENTITIES[name]).write.mode("append").json(folder)
        landing.write_batch(rows, ENTITIES[name], folder.replace("run_id=a", f"run_id=b{i}"))
        got = run_bronze(spark, root, "shop", f"r{i}", DAY, DAY, name)[0]
        assert got["rows_written"] == i + 6
    assert run_bronze(spark, root, "shop", "r3", DAY, DAY, name)[0]["status"] == "already_processed"


def test_missing_landing_folder(spark, tmp_path):
    got = run_bronze(spark, str(tmp_path), "shop", "r", DAY, DAY, "cupons")
    assert got[0]["status"] == "no_landing_files"


def test_csv_route(lake, spark, tmp_path):
    for n, e in ENTITIES.items():
        csv_files.write(lake.shop[n].select(*e.columns), f"{tmp_path}/in/{n}.csv")
    export_star(spark, f"{tmp_path}/in", f"{tmp_path}/out", single_file=True)
    flat = spark.read.csv(f"{tmp_path}/out/obt_vendas.csv", header=True)
    assert flat.count() == 6000
    direct = lake.shop["itens_pedido"].agg(F.sum("subtotal")).first()[0]
    assert flat.agg(F.sum(F.col("receita_liquida").cast("decimal(18,2)"))).first()[0] == direct
    assert len(os.listdir(f"{tmp_path}/out")) == 9
