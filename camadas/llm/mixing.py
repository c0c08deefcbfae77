"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camadas.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
BUCKETS = 4096


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def word_density(text: str = "text") -> Column:
    """The default quality weight: words per six characters, kept between a quarter and two."""
    share = 6.0 * F.col("size") / F.greatest(F.length(F.coalesce(F.col(text), F.lit(""))), F.lit(1))
    return F.least(F.greatest(share, F.lit(0.25)), F.lit(2.0))


def sampling_key(weight: Column, seed: str) -> Column:
    """An exponential variate divided by the weight; ascending order is weighted sampling without
    replacement. The uniform number is 48 bits of an md5 of seed and id, so reruns agree; a row without
    id takes the md5 of its text instead of the id."""
    known = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), known)), 1, 12), 16, 10)
    uniform = (bits.cast("double") + 0.5) / float(2**48)
    return -F.ln(uniform) / weight


def source_targets(sizes: DataFrame, share: float, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Per source its size, target, full epochs and the rest to select.

    Water filling in closed form: in ascending order of cap over weight, a source is capped exactly if
    its ratio is at most the level that the sources from it on would get. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * epochs)
    rising = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) * share
             - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    common = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(
        Window.partitionBy())["level"]
    targets = levels.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        common * F.col("weight")))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return targets.select("source", "source_size", "target", full.cast("long").alias("full")).withColumn(
        "rest", F.col("target") - F.col("full") * F.col("source_size"))


def mix(docs: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (3, 1, 2), epochs: int = 2,
        quality: Column | None = None, seed: str = "mix") -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies, taken.

    Every document of a source is taken ``full`` times; the rest of the target goes to whole documents
    in ascending order of their sampling key until the next one would miss it by more than it brings.
    ``quality`` weighs documents and may use ``text`` and ``size`` (default ``word_density``).

    A source's running sum never sorts the source: keys fall into ``BUCKETS`` ranges, whose sums give
    the one range that holds the boundary, and only that range is sorted.

    Null text has size 0 and is taken 0 words; a null source is a source, named last; null, zero or
    negative weights count as 1e-6; rows without id draw by their text; equal keys are ordered by id,
    then size, so repeated rows are interchangeable; no rows give no rows. Other columns are ignored.
    """
    sized = docs.select("doc_id", "source", "text").withColumn("size", word_count())
    weight = F.coalesce(quality if quality is not None else word_density(), F.lit(1e-6))
    sized = sized.select("doc_id", "source", "size",
                         sampling_key(F.greatest(weight.cast("double"), F.lit(1e-6)), seed).alias("key"))
    sized = sized.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)))
    sized = materialize(sized, "mix-sizes")

    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    totals = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(totals, share, weights, epochs).withColumnRenamed("source", "plan_source")
    targets = materialize(targets, "mix-targets")
    reached = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket"))
    edges = sums.withColumn("reached", reached).join(targets, F.col("source").eqNullSafe(F.col("plan_source")))
    edges = edges.where(F.col("reached") >= F.col("rest")).groupBy(F.col("source").alias("edge_source")).agg(
        F.min(F.struct("bucket", (F.col("reached") - F.col("bucket_size")).alias("before"))).alias("edge"))
    plan = targets.join(edges, F.col("plan_source").eqNullSafe(F.col("edge_source")), "left").select(
        "plan_source", "source_size", "target", "full", "rest",
        F.coalesce("edge.bucket", F.lit(-1)).alias("edge_bucket"), F.coalesce("edge.before", F.lit(0)).alias("before"))
    plan = materialize(plan, "mix-plan")

    placed = sized.join(plan, sized["source"].eqNullSafe(plan["plan_source"])).drop("plan_source")
    inside = placed.where(F.col("bucket") != F.col("edge_bucket")).withColumn(
        "chosen", (F.col("bucket") < F.col("edge_bucket")).cast("long"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum("size").over(order)
    boundary = placed.where(F.col("bucket") == F.col("edge_bucket")).withColumn("upto", upto)
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - (F.col("upto") - F.col("size"))
    boundary = boundary.withColumn("chosen", ((F.col("upto") <= F.col("rest")) | nearer).cast("long")).drop("upto")
    both = inside.unionByName(boundary).withColumn("copies", F.col("full") + F.col("chosen"))
    return both.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))
