"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot join key is split even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # staged and stored tables are written as often as they are read: bytes cost more than the codec
    "spark.sql.parquet.compression.codec": "zstd",
    # a step's shuffle files go when the step ends, not when the driver happens to collect its frames
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "camadas", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="camadas-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a written table, so several consumers read it and none recomputes it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame | Sequence[DataFrame], label: str) -> Iterator[DataFrame]:
    """``materialize`` for the length of a block; the table is removed afterwards.

    Several frames of one schema are written one after the other: the shuffle files of one go before the next.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark, path = frames[0].sparkSession, scratch_dir(frames[0].sparkSession, label)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        for frame in frames:
            frame.write.mode("append").parquet(path)
        yield spark.read.schema(frames[0].schema).parquet(path)
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def few_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A handful of rows as literals: ``createDataFrame`` would start Python workers for them."""
    fields = T.StructType.fromDDL(schema).fields
    cells = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields))) for row in rows]
    if not cells:
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))


def side_by_side(work: Callable, items: Iterable, at_once: int = 8) -> list:
    """Submit independent tables together, so one table's last tasks do not idle the cluster.

    Results keep the order of the items; the first failure is raised after the others have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [f.result() for f in [pool.submit(work, i) for i in items]]


def after_needs(work: Callable, needs: Mapping[str, Collection[str]], at_once: int = 8) -> dict:
    """``side_by_side`` for items that need others: each is submitted as soon as those it needs have ended.

    After a failure nothing more is submitted; it is raised when what runs has ended.
    """
    waiting, running, done, failed = dict(needs), {}, {}, None
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        while running or waiting and not failed:
            left = waiting.keys() | set(running.values())
            for item in [i for i in waiting if not failed and not left.intersection(waiting[i])]:
                del waiting[item]
                running[pool.submit(work, item)] = item
            if not running:
                raise ValueError(f"need each other: {sorted(waiting)}")
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                item = running.pop(ended)
                if ended.exception() is None:
                    done[item] = ended.result()
                else:
                    failed = failed or ended.exception()
    if failed:
        raise failed
    return done
