"""Typed CSV in, CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camadas.contracts import Entity
from camadas.functions.text import cell
from camadas.sources.landing import FILE_ROWS

_KINDS = {"integer": "int", "number": "float", "boolean": "bool", "date": "date"}


def read_typed(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """Read text cells by the contract's names and type them; a bad cell is null, not an error."""
    schema = ", ".join(f"`{c}` string" for c in entity.columns)
    text = spark.read.schema(schema).csv(path, header=True, multiLine=False, enforceSchema=False)
    return text.select(
        *(cell(F.col(f.name), _KINDS.get(f.wire, "string")).alias(f.name) for f in entity.fields)
    )


def write(
    df: DataFrame, path: str, single_file: bool = False, compression: str | None = None
) -> None:
    """CSV with a header, one file per task, or one file in all where ``single_file`` asks for it.

    Files of many tasks hold at most ``FILE_ROWS`` rows, as a compressed one is read by one task.
    """
    if single_file:
        df = df.coalesce(1)
    rows = 0 if single_file else FILE_ROWS
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).csv(path, header=True, compression=compression)
