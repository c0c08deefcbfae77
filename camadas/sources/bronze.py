"""Landing files into the append-only raw table: scan, lineage, ledger."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lineage columns of the raw table and the path parts they come from.
SOURCE_FILE = "_bronze_source_file"
EXTRACTION_DATE = "_bronze_extraction_date"
LANDING_RUN = "_bronze_landing_run_id"
PIPELINE_RUN = "_bronze_airflow_run_id"
INGESTED_AT = "_bronze_ingested_at"
PARTITION = "ingestion_date"
EXTRACTION_DATE_IN_PATH = r"/extraction_date=([^/]+)/"
RUN_ID_IN_PATH = r"/run_id=([^/]+)/"
FOLDER_IN_PATH = r"^(.*)/[^/]+$"
FILE_GLOB = "*.{json,json.gz}"


def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all landing files, from the listing alone: no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = reader.option("pathGlobFilter", FILE_GLOB).load(folder)
    return found.select(F.col("_metadata.file_path").alias(SOURCE_FILE))


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line of every JSON file below the paths, content untouched."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", FILE_GLOB)
    lines = reader.text(list(paths))
    return lines.select(
        F.col("value").alias("raw_document"), F.col("_metadata.file_path").alias(SOURCE_FILE)
    )


def path_lineage(path: Column) -> list[Column]:
    """Extraction day and landing run, as the file's path names them."""
    day = F.nullif(F.regexp_extract(path, EXTRACTION_DATE_IN_PATH, 1), F.lit(""))
    return [
        day.try_cast("date").alias(EXTRACTION_DATE),
        F.regexp_extract(path, RUN_ID_IN_PATH, 1).alias(LANDING_RUN),
    ]


def with_lineage(lines: DataFrame, run_id: str, at: Column, day: date) -> DataFrame:
    return lines.select(
        "raw_document", SOURCE_FILE, *path_lineage(F.col(SOURCE_FILE)),
        F.lit(run_id).alias(PIPELINE_RUN), at.alias(INGESTED_AT), F.lit(day).alias(PARTITION),
    )


def not_ingested(rows: DataFrame, table: DataFrame | None) -> DataFrame:
    """Rows (lines or bare file names) whose file the raw table does not hold yet."""
    if table is None:
        return rows
    return rows.join(table.select(SOURCE_FILE).distinct(), SOURCE_FILE, "left_anti")
