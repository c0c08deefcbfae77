"""Cross-site boilerplate lines: distinct sites per line by mergeable sketches, exact near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.session import materialize

LOG_K = 10
# Three standard errors of a sketch with 2^LOG_K registers.
MARGIN = 3 * 1.04 / (2 ** (LOG_K / 2))


def line_key(line: Column) -> Column:
    return F.md5(line)


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def lines_of(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, key, site) of every line that is not blank."""
    split = docs.select("doc_id", F.col(site).alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    return split.select("site", trimmed(F.col("line")).alias("line")).where("line != ''").select(
        "site", F.unhex(line_key(F.col("line"))).alias("key"))


def boilerplate(docs: DataFrame, least_sites: int, site: str = "source") -> DataFrame:
    """(key): hashes of the lines on ``least_sites`` distinct sites or more; exact.

    One sketch per line hash, merged by the aggregation. Only hashes whose estimate is within three
    standard errors of the threshold are counted exactly; the others lie clearly on one side.
    """
    lines = lines_of(docs, site).where("site is not null")
    spread = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"))
    low, high = least_sites * (1 - MARGIN) - 0.5, least_sites * (1 + MARGIN) + 0.5
    spread = materialize(spread.where(F.col("sites") >= low), "line-spread")
    near = spread.where(F.col("sites") <= high).select("key")
    exact = lines.join(near, "key", "left_semi").distinct().groupBy("key").agg(F.count("*").alias("n"))
    return spread.where(F.col("sites") > high).select("key").unionByName(
        exact.where(F.col("n") >= least_sites).select("key"))


def drop_boilerplate(docs: DataFrame, least_sites: int = 5, site: str = "source") -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``, plus n_lines and n_removed.

    A line is compared without spaces, tabs and carriage returns at its ends; blank lines are neither
    counted nor removed. Rows with a null site keep and lose lines like others but add no site. Null text
    stays null with zero lines; empty text has none. A text that loses all its lines becomes empty.
    Repeated rows and repeated or null ids are handled row by row; all columns of ``docs`` are returned,
    those named n_lines or n_removed replaced; no rows give no rows.
    """
    keys = materialize(boilerplate(docs, least_sites, site), "line-boilerplate")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "text")]
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), "text")
    pieces = F.split(F.coalesce("text", F.lit("")), "\n")
    hashed = F.transform(F.transform(pieces, trimmed), lambda x: F.when(x != "", F.unhex(line_key(x))))
    # a text's candidate keys meet the boilerplate keys once, whatever the number of their occurrences
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1))
    texts = whole.where("text is not null").select(mark.alias("mark"), F.explode(F.array_distinct(hashed)).alias("key"))
    hit = texts.where("key is not null").join(keys, "key", "left_semi").groupBy("mark").agg(F.collect_set("key").alias("hit"))
    joined = whole.withColumn("mark", mark).join(hit, "mark", "left")
    none = F.array().cast("array<binary>")
    flagged = joined.withColumn("pieces", F.arrays_zip(pieces.alias("line"), hashed.alias("key")))
    kept = F.filter("pieces", lambda p: p["key"].isNull() | ~F.array_contains(F.coalesce("hit", none), p["key"]))
    filled = F.size(F.filter("pieces", lambda p: p["key"].isNotNull()))
    left = F.size(F.filter(kept, lambda p: p["key"].isNotNull()))
    done = flagged.withColumn("n_lines", filled.cast("long")).withColumn("n_removed", (filled - left).cast("long")).withColumn(
        "text", F.when(F.col("text").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda p: p["line"]), "\n")))
    return done.select(*[F.col(f"row.`{n}`").alias(n) for n in names], "text", "n_lines", "n_removed")
