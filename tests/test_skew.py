"""Hot keys: one value holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from camadas.contracts import Reference
from camadas.operators import quality
from camadas.operators.history import lookup_as_of


@pytest.fixture
def small_limits(spark):
    """Thresholds at which a test-sized partition counts as skewed; broadcasting off."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=300_000):
    """Ids with a key that is 1 for a third of them."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 2).cast("bigint")
    return spark.range(0, n, 1, 8).select("id", key.alias("parent"), F.md5(F.col("id").cast("string")).alias("x"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_reference_is_split(spark, small_limits):
    parents = spark.range(0, 3000).select(F.col("id").alias("pid"))
    ref = Reference("parent", "p", "pid")
    flagged = quality.flag_reference(hot(spark), ref, parents, "id", "ok")
    counts = flagged.groupBy("ok").count()
    assert dict(map(tuple, counts.collect())) == {
        True: hot(spark).filter("parent < 3000").count(), False: hot(spark).filter("parent >= 3000").count()}
    assert "skew=true" in final_plan(flagged.select("id", "ok", "x"))


def test_hot_dimension_key_is_split(spark, small_limits):
    dim = spark.range(1, 6000).selectExpr(
        "id as parent", "cast(id as string) as sk", "timestamp '1900-01-01' as dw_valid_from",
        "timestamp '9999-12-31' as dw_valid_to")
    fact = hot(spark).withColumn("at", F.lit("2024-01-01").cast("date"))
    got = lookup_as_of(fact, dim, "parent", "sk", "at", "id")
    assert got.filter("sk is null or sk <> cast(parent as string)").count() == 0
    assert "skew=true" in final_plan(got)
