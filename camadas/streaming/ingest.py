"""The raw ingest as a stream that runs until its input is exhausted.

The file source keeps its own ledger of seen files in the checkpoint and the Parquet sink commits
each file list atomically, so every file is ingested exactly once without scanning the table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from camadas.contracts import Entity
from camadas.functions.extjson import decode
from camadas.sources import bronze
from camadas.sources.landing import as_utc


def landing_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """One row per line of every file below the folder, as files appear."""
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", bronze.FILE_GLOB)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(folder)
    return lines.select(
        F.col("value").alias("raw_document"),
        F.col("_metadata.file_path").alias(bronze.SOURCE_FILE),
    )


def ingest_available(
    spark: SparkSession, folder: str, table: str, checkpoint: str, run_id: str,
    logical_date: datetime, at: datetime, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append every file not seen before, then stop. The table must be written by streams only."""
    lines = landing_stream(spark, folder, files_per_batch)
    rows = bronze.with_lineage(lines, run_id, F.lit(as_utc(at)), as_utc(logical_date).date())
    return (
        rows.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy(bronze.PARTITION)
        .trigger(availableNow=True)
        .start()
    )


def decoded_stream(lines: DataFrame, entity: Entity) -> DataFrame:
    return decode(lines, entity).drop("raw_document")
