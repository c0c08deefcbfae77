"""Star schema and flat sales table straight from typed CSV files, back to CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from camadas.entities import ENTITIES
from camadas.plans.marts import flat_sales
from camadas.plans.star import BUILDERS
from camadas.sources import csv_files

FLAT_TABLE = "obt_vendas"


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: csv_files.read_typed(spark, f"{folder}/{n}.csv", e) for n, e in ENTITIES.items()}


def export_star(
    spark: SparkSession, source: str, target: str, single_file: bool = False, compression: str | None = None
) -> None:
    """Natural keys only: the CSV route has no versions to point at."""
    tables = read_sources(spark, source)
    outputs = {name: build(tables) for name, build in BUILDERS.items()}
    outputs[FLAT_TABLE] = flat_sales(tables)
    for name, df in outputs.items():
        csv_files.write(df, f"{target}/{name}.csv", single_file, compression)
