"""Tables and years that need not wait for each other, and checks that leave rows where they are."""

import datetime as dt
import threading
import time
from contextlib import ExitStack

import pytest

from camadas.contracts import Reference
from camadas.entities import ENTITIES, MODELS
from camadas.operators import audit, upsert
from camadas.operators.quality import flag_reference
from camadas.plans import carry, gold
from camadas.session import after_needs, few_rows
from camadas.sources import landing
from camadas.sources.tables import FolderTable
from tests.conftest import plan, rows

AT = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)


def test_items_start_when_their_needs_have_ended():
    order, lock = [], threading.Lock()

    def work(item):
        time.sleep(0.5 if item == "slow" else 0.01)
        with lock:
            order.append(item)
        if item == "bad":
            raise LookupError(item)
        return item.upper()

    done = after_needs(work, {"slow": [], "quick": [], "child": ["quick"], "last": ["slow", "child"]})
    assert done == {"slow": "SLOW", "quick": "QUICK", "child": "CHILD", "last": "LAST"}
    assert order.index("child") < order.index("slow") < order.index("last")
    order.clear()
    with pytest.raises(LookupError):
        after_needs(work, {"bad": [], "slow": [], "never": ["bad"]})
    assert sorted(order) == ["bad", "slow"]
    with pytest.raises(ValueError):
        after_needs(work, {"a": ["b"], "b": ["a"]})
    assert after_needs(work, {"only": ["elsewhere"]}) == {"only": "ONLY"}


def test_collections_are_extracted_together(spark, tmp_path, monkeypatch):
    both, met = threading.Barrier(2), []

    def write(batch, entity, folder, field="updated_at", compression=None):
        both.wait(30)
        met.append(entity.name)
        return {"document_count": batch.count(), "max_updated_at": AT}

    monkeypatch.setattr(landing, "write_batch", write)
    sources = {n: spark.range(3).selectExpr("id", "timestamp'2001-01-01' as updated_at") for n in ("clientes", "cupons")}
    results, after = landing.extract(sources, ENTITIES, str(tmp_path), "shop", "r", AT, {})
    assert sorted(met) == ["clientes", "cupons"]
    assert [(r["table"], r["document_count"]) for r in results] == [("clientes", 3), ("cupons", 3)]
    assert after == {"clientes": AT, "cupons": AT}


def test_counted_parents_leave_the_rows_where_they_are(spark):
    lines = spark.sql("select id, if(id % 5 = 0, null, id % 7) as parent from range(100)")
    parents = spark.sql("select explode(array(id, id)) as id from range(6)").repartition(3)
    for required in (True, False):
        ref = Reference("parent", "p", "id", required=required)
        free, counted = (flag_reference(lines, ref, parents, "id", "found", n) for n in (None, 12))
        assert rows(free) == rows(counted) and len(rows(counted)) == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(flag_reference(lines, ref, parents, "id", "found"))
        kept = plan(flag_reference(lines, ref, parents, "id", "found", 12))
        assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept
        assert "SortMergeJoin" in plan(flag_reference(lines, ref, parents, "id", "found", 1_000_001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _payments(spark, moved, value):
    return spark.sql(f"""select id as pagamento_key, '{value}' as valor, concat('{value}', id) as {gold.RECORD_HASH},
        cast(1995 + (id + {moved}) % 5 as int) as ano from range(60)""")


def test_years_of_a_fact_are_replaced_in_lots(spark, tmp_path, monkeypatch):
    model, key = MODELS["fato_pagamentos"], "pagamento_key"
    work = carry.Carry(spark, str(tmp_path), "shop", "r", AT, ExitStack())
    written = []

    class Table(FolderTable):
        def rewrite(self, df, parts=()):
            written.append(list(parts))
            super().rewrite(df, parts)

    for lot_rows, most, want in ((1000, 1000, 1), (1, 1000, 5), (1000, 2, 1)):
        monkeypatch.setattr(carry, "LOT_ROWS", lot_rows)
        monkeypatch.setattr(upsert, "BROADCAST_ROWS", most)
        store = Table(spark, str(tmp_path / f"lots-{lot_rows}-{most}"), "ano")
        store.rewrite(_payments(spark, 0, "a"))
        # what a run left behind that died between two years: rows that moved are in both of them
        store.rewrite(store.read().unionByName(_payments(spark, 1, "b").filter("pagamento_key % 5 = 0 and pagamento_key < 30")))
        keys = spark.range(30).withColumnRenamed("id", key)
        written.clear()
        counts = work._fact(store, _payments(spark, 1, "b").filter(f"{key} < 30").localCheckpoint(), keys, 30, model)
        assert counts == {"inserted": 0, "updated": 30, "unchanged": 6, "deleted": 0, "rows_written": 30}
        assert len(written) == want and sorted(p for lot in written for p in lot) == [1995, 1996, 1997, 1998, 1999]
        expected = _payments(spark, 1, "b").filter(f"{key} < 30").unionByName(_payments(spark, 0, "a").filter(f"{key} >= 30"))
        assert rows(store.read(), key, "valor", "ano") == rows(expected, key, "valor", "ano")


def test_one_look_at_the_actions(spark):
    old, new = (spark.createDataFrame(r, "id int, h string, ano int") for r in (
        [(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "a", None)], [(1, "a", 1), (2, "b", 3), (4, "b", 4), (5, "a", 5)]))
    actions = upsert.sync_actions(old, new, "id", "h", ["ano"])
    counts, parts = upsert.sync_summary(actions, "ano")
    assert counts == {"inserted": 1, "updated": 2, "unchanged": 1, "deleted": 1, "rows_written": 4}
    assert counts == upsert.action_counts(actions, ["inserted", "updated", "unchanged", "deleted"]).first().asDict()
    assert parts == [None, 1, 2, 3, 4, 5]


def test_few_rows_without_python_workers(spark):
    schema = "a string, n bigint, d date"
    made = few_rows(spark, [("x", 1, dt.date(2001, 2, 3)), (None, None, None)], schema)
    assert made.dtypes == spark.createDataFrame([], schema).dtypes == few_rows(spark, [], schema).dtypes
    assert rows(made) == rows(spark.createDataFrame([("x", 1, dt.date(2001, 2, 3)), (None, None, None)], schema))
    assert few_rows(spark, [], schema).count() == 0
    assert "ExistingRDD" not in plan(audit.metrics_frame(spark, [{"table": "t", "status": "s"}], ("n",)))
    instants = {"a": dt.datetime(1, 1, 1, tzinfo=dt.timezone.utc), "b": AT, "c": None}
    stored = landing.checkpoint_rows(spark, instants).selectExpr("collection", "unix_micros(checkpoint) as us")
    assert rows(stored) == [("a", -62135596800000000), ("b", 1009843200000000)]


def test_stored_schema_is_inferred_once(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), "ano")
    table.rewrite(spark.sql("select 1 as id, 2001 as ano"))
    seen = []
    for _ in range(2):
        spark.sparkContext.setJobGroup(f"read-{len(seen)}", "")
        seen.append(table.read().columns)
    assert seen[0] == seen[1] == ["id", "ano"]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("read-1")) == 0
    table.rewrite(spark.sql("select 1 as id, 'x' as name, 2001 as ano"))
    assert table.read().columns == ["id", "name", "ano"]
    spark.sparkContext.setJobGroup("", "")
