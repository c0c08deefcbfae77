"""Incremental extraction into immutable JSON-lines files, driven by a checkpoint."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from camadas.contracts import Entity
from camadas.entities import OVERLAP_HOURS, WATERMARK
from camadas.functions.extjson import wrapped
from camadas.session import few_rows, side_by_side


# Lines of a landing file: a compressed one is read by one task.
FILE_ROWS = 100_000


def safe_component(text: str) -> str:
    """A path component: anything unusual becomes an underscore, nothing at all is an error."""
    cleaned = re.sub(r"[^A-Za-z0-9._-]+", "_", text.strip())
    if not cleaned:
        raise ValueError("a path component cannot be empty")
    return cleaned


def as_utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def parse_instant(text: str | None) -> datetime | None:
    """ISO text to UTC; text without a zone is UTC already."""
    return as_utc(datetime.fromisoformat(text.replace("Z", "+00:00"))) if text else None


def format_instant(value: datetime) -> str:
    return as_utc(value).isoformat().replace("+00:00", "Z")


def changed_since(
    df: DataFrame, checkpoint: datetime | None, field: str = WATERMARK,
    overlap_hours: int = OVERLAP_HOURS, ordered: bool = False,
) -> DataFrame:
    """Rows at or after ``checkpoint - overlap``; without a checkpoint, all rows.

    The bound is a literal, so it reaches the source's own filter. Sorting is only for readers that
    need the order: it costs a range shuffle.
    """
    if checkpoint is not None:
        if overlap_hours < 0:
            raise ValueError("overlap_hours cannot be negative")
        bound = as_utc(checkpoint) - timedelta(hours=overlap_hours)
        df = df.filter(F.col(field) >= F.lit(bound))
    return df.orderBy(F.col(field)) if ordered else df


def next_checkpoint(batch: DataFrame, old: datetime | None, field: str = WATERMARK) -> DataFrame:
    """One row: how many rows the batch has and where the next extraction starts from."""
    previous = F.lit(as_utc(old)) if old else F.lit(None)
    return batch.agg(
        F.count(F.lit(1)).alias("document_count"),
        F.coalesce(F.max(field), previous.cast("timestamp")).alias("checkpoint"),
    )


def batch_folder(root: str, database: str, collection: str, day: date, run_id: str) -> str:
    return (
        f"{root.rstrip('/')}/landing/{safe_component(database)}/{safe_component(collection)}/"
        f"extraction_date={day.isoformat()}/run_id={safe_component(run_id)}"
    )


def write_batch(
    batch: DataFrame, entity: Entity, folder: str, field: str = WATERMARK, compression: str | None = None
) -> dict:
    """Write a batch as JSON lines (files of at most ``FILE_ROWS``) and report its size and newest row.

    Counting rides along with the write. A retried run replaces its own batch. An empty one leaves no file.
    """
    if batch.isEmpty():
        return {"document_count": 0, "max_updated_at": None}
    seen = Observation()
    observed = batch.observe(seen, F.count(F.lit(1)).alias("n"), F.max(field).alias("newest"))
    writer = wrapped(observed, entity).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
    writer.option("ignoreNullFields", "false").json(folder, compression=compression)
    newest = seen.get["newest"]
    return {"document_count": seen.get["n"], "max_updated_at": as_utc(newest) if newest else None}


def extract(
    sources: Mapping[str, DataFrame], entities: Mapping[str, Entity], root: str, database: str,
    run_id: str, logical_date: datetime, checkpoints: Mapping[str, datetime | None],
    overlap_hours: int = OVERLAP_HOURS, monotonic: bool = False, compression: str | None = None,
) -> tuple[list[dict], dict[str, datetime | None]]:
    """Extract every named source; returns the results and the checkpoints to store.

    Nothing is stored here: the caller commits the checkpoints once everything, the manifest
    included, has succeeded. ``monotonic`` keeps a checkpoint from moving backwards when the newest
    source rows have disappeared.
    """
    folders = {n: batch_folder(root, database, n, as_utc(logical_date).date(), run_id) for n in sources}

    def one(name: str) -> dict:
        batch = changed_since(sources[name], checkpoints.get(name), overlap_hours=overlap_hours)
        return write_batch(batch, entities[name], folders[name], compression=compression)

    results, advanced = [], {}
    for name, found in zip(folders, side_by_side(one, folders)):
        old, folder = checkpoints.get(name), folders[name]
        newest = found["max_updated_at"] or old
        advanced[name] = max(old, newest) if monotonic and old and newest else newest
        status = "written" if found["document_count"] else "no_changes"
        results.append({"table": name, "status": status, "folder": folder, **found})
    return results, advanced


def checkpoint_rows(spark: SparkSession, values: Mapping[str, datetime | None]) -> DataFrame:
    """One small row per collection."""
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    rows = [(n, (v.astimezone(timezone.utc) - epoch) // timedelta(microseconds=1)) for n, v in values.items() if v is not None]
    micros = few_rows(spark, rows, "collection string, checkpoint bigint")
    return micros.withColumn("checkpoint", F.timestamp_micros("checkpoint"))
