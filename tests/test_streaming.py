import datetime as dt

from camadas.entities import ENTITIES
from camadas.functions.extjson import decode
from camadas.sources import bronze, landing
from camadas.streaming.ingest import ingest_available
from workload.shop import Shop

AT = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)


def land(spark, root, run, where):
    rows = Shop(spark, "/root/testdata/sf0.001")["pedidos"].filter(where)
    folder = landing.batch_folder(root, "shop", "pedidos", AT.date(), run)
    landing.write_batch(rows, ENTITIES["pedidos"], folder)
    return rows.count()


def test_each_file_is_ingested_once(spark, tmp_path):
    root = str(tmp_path)
    args = (spark, f"{root}/landing/shop/pedidos", f"{root}/bronze", f"{root}/cp")
    first = land(spark, root, "a", "id_pedido % 2 = 0")
    ingest_available(*args, "r1", AT, AT).awaitTermination()
    second = land(spark, root, "b", "id_pedido % 2 = 1")
    for run in ("r2", "r3"):
        ingest_available(*args, run, AT, AT).awaitTermination()
    table = spark.read.parquet(f"{root}/bronze")
    counts = {r[bronze.PIPELINE_RUN]: r["count"] for r in table.groupBy(bronze.PIPELINE_RUN).count().collect()}
    assert counts == {"r1": first, "r2": second}
    decoded = decode(table.select("raw_document"), ENTITIES["pedidos"])
    assert decoded.filter("id_pedido is null").count() == 0


def test_late_and_replayed_rows_are_all_kept(spark, tmp_path):
    """The raw table holds every delivered row, however old; replays are settled by the merge."""
    root = str(tmp_path)
    args = (spark, f"{root}/landing/shop/pedidos", f"{root}/bronze", f"{root}/cp")
    n = land(spark, root, "a", "id_pedido % 3 = 0")
    ingest_available(*args, "r1", AT, AT).awaitTermination()
    n += land(spark, root, "b", "true")
    ingest_available(*args, "r2", AT, AT).awaitTermination()
    rows = decode(spark.read.parquet(f"{root}/bronze").select("raw_document"), ENTITIES["pedidos"])
    assert rows.count() == n
    assert rows.select("id_pedido").distinct().count() == Shop(spark, "/root/testdata/sf0.001")["pedidos"].count()
