import datetime as dt

import pytest
from pyspark.sql import functions as F

from camadas.contracts import Entity, Field, Reference, Unique
from camadas.functions.keys import dedup_key
from camadas.operators import audit, quality
from camadas.operators.dedup import first_per_key, newest_first
from camadas.plans import marts
from tests.conftest import plan, rows
from workload.shop import Shop

T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
ITEM = Entity(
    "item", "id",
    (
        Field("id", "integer", "bigint", low=1),
        Field("code", "string", "string", pattern="^[a-z]+$"),
        Field("kind", "string", "string", required=False, one_of=("x", "y")),
        Field("size", "integer", "bigint", required=False, low=0, high=9),
        Field("parent", "integer", "bigint", required=False),
        Field("updated_at", "date", "timestamp"),
    ),
    references=(Reference("parent", "parents", "pid", required=False),),
    unique=(Unique(("code",), "dup_code", "same code", "kind", "x"),),
)
SCHEMA = "id bigint, code string, kind string, size bigint, parent bigint, updated_at timestamp"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_violations_name_every_broken_rule(spark):
    df = frame(
        spark, (1, "a", "x", 0, None, T0), (None, "", "z", 10, None, None), (2, "B", None, None, None, T0)
    )
    got = df.select(quality.violations(ITEM), quality.is_valid(ITEM)).collect()
    assert got[0][0] == [] and got[0][1] is True
    assert got[1][0] == [
        "id:required", "code:required", "code:pattern", "kind:domain", "size:maximum",
        "updated_at:required",
    ] and got[1][1] is False
    assert got[2][0] == ["code:pattern"]


def test_newest_version_wins_even_if_invalid(spark):
    df = frame(spark, (1, "a", None, 1, None, T0), (1, "BAD", None, 1, None, T1),
               (2, "c", None, 1, None, None), (2, "d", None, 1, None, T0))
    newest = first_per_key(df, ["id"], newest_first("updated_at", "code"))
    assert rows(newest, "id", "code") == [(1, "BAD"), (2, "d")]


def test_documents_without_key_only_collapse_with_equals(spark):
    raw = spark.createDataFrame([(None, "p"), (None, "p"), (None, "q"), (1, "r")], "id bigint, raw string")
    keyed = raw.withColumn("_k", dedup_key(F.col("id"), F.col("raw")))
    assert first_per_key(keyed, ["_k"], ["raw"]).count() == 3


def test_dedup_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    assert "WindowGroupLimit" in plan(first_per_key(df, ["k"], ["id"]))


@pytest.mark.parametrize("partitions", [1, 8])
def test_unique_rule_matches_a_ranking(spark, partitions):
    """A third of all rows share one code; rows outside the condition always pass."""
    data = [
        (i, "hot" if i % 3 == 0 else f"c{i % 50}", "x" if i % 4 else "y", 1, None,
         T0 + dt.timedelta(days=i % 7))
        for i in range(1, 600)
    ]
    df = frame(spark, *data).repartition(partitions)
    got = quality.flag_duplicates(df, ITEM.unique[0], "id", ["updated_at"]).filter("_loser")
    best = {}
    for r in data:
        if r[2] == "x":
            best[r[1]] = max(best.get(r[1], (dt.datetime.min, 0)), (r[5], r[0]))
    want = {r[0] for r in data if r[2] == "x" and best[r[1]][1] != r[0]}
    assert {r.id for r in got.collect()} == want
    assert got.count() == len(want)


def test_unique_rule_ignores_null_conditions_and_groups_null_values(spark):
    rule = Unique(("parent",), "p", "p", "kind", "x")
    df = frame(spark, (1, "a", None, 1, 5, T0), (2, "a", "x", 1, 5, T0), (3, "a", "x", 1, None, T0),
               (4, "a", "x", 1, None, T1))
    flagged = quality.flag_duplicates(df, rule, "id", ["updated_at"])
    assert rows(flagged, "id", "_loser") == [(1, False), (2, False), (3, True), (4, False)]


def test_references(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,)], "pid bigint")
    df = frame(spark, (1, "a", None, 1, 1, T0), (2, "a", None, 1, 9, T0), (3, "a", None, 1, None, T0))
    optional = ITEM.references[0]
    required = Reference("parent", "parents", "pid")
    assert rows(quality.resolved(df, optional, parents, "id"), "id") == [(1,), (3,)]
    assert rows(quality.resolved(df, required, parents, "id"), "id") == [(1,)]
    assert rows(quality.orphans(df, required, parents), "id") == [(2,)]
    flagged = quality.flag_reference(df, required, parents, "id", "ok")
    assert rows(flagged, "id", "ok") == [(1, True), (2, False), (3, False)]


def test_null_references_are_spread_and_never_match(spark):
    parents = spark.createDataFrame([(-(1 << 62) - i,) for i in range(5000)], "pid bigint")
    df = spark.range(2000).select("id", F.lit(None).cast("bigint").alias("parent"))
    ref = Reference("parent", "parents", "pid", required=False)
    out = quality.flag_reference(df, ref, parents, "id", "ok")
    assert out.count() == 2000 and out.filter("ok").count() == 2000


def test_status_accounting_adds_up(spark):
    parents = {"parents": spark.createDataFrame([(1,)], "pid bigint")}
    read = frame(
        spark, (1, "a", "x", 1, 1, T0), (1, "a", "x", 1, 1, T1), (2, "a", "x", 1, 1, T0),
        (3, "BAD", "x", 1, 1, T2), (4, "b", "x", 1, 7, T0), (5, "c", "y", 1, None, T0),
        (6, "c", "y", 1, None, T0),
    )
    newest = first_per_key(read, ["id"], newest_first("updated_at"))
    judged = quality.assess(newest, ITEM, parents, ["updated_at"])
    assert rows(judged, "id", "_status") == [
        (1, "valid"), (2, "business"), (3, "field"), (4, "referential"), (5, "valid"), (6, "valid"),
    ]
    a = audit.account(read, judged, "item").first()
    assert a.records_read == a.duplicates_removed + a.records_rejected + a.records_valid
    assert (a.duplicates_removed, a.field_rejected, a.business_rule_rejected,
            a.referential_rejected, a.records_valid) == (1, 1, 1, 1, 3)


def test_empty_input(spark):
    judged = quality.assess(
        frame(spark), ITEM, {"parents": spark.createDataFrame([], "pid bigint")}, ["updated_at"]
    )
    assert judged.count() == 0
    assert audit.account(frame(spark), judged, "item").first().records_valid == 0


def test_whole_flat_table_moves_item_rows_with_the_product_only(spark):
    """What goes through the second shuffle of items are the product's three texts, not the order's columns."""
    shop = Shop(spark, "/root/testdata/sf0.001")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flat = marts.flat_sales(shop)
        moved = [line for line in flat._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
        assert "Inner" in moved[0] and "(id_pedido#" in moved[0] and "(id_produto#" in moved[1], moved
        assert flat.count() == shop["itens_pedido"].count()
        named = marts.flat_sales(shop, ["id_item", "produto", "cliente", "status_entrega"])
        assert rows(named) == rows(flat, *named.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
