"""Result tables: typed Parquet, overwritten or appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estate.operators.inventory import external_location_rows, inventory_rows


def _overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_inventory(objects: DataFrame, path: str, *, captured_at) -> None:
    """Full overwrite in the stored shape, stamped with the capture time."""
    _overwrite(inventory_rows(objects, captured_at=captured_at), path)


def write_external_locations(locations: DataFrame, path: str) -> None:
    _overwrite(external_location_rows(locations), path)


def write_lineage(edges: DataFrame, path: str) -> None:
    _overwrite(edges, path)


def write_validation_results(results: DataFrame, path: str) -> None:
    _overwrite(results, path)


def append_rows(rows: DataFrame, path: str) -> None:
    """Append to an event table: migration log, snapshots, cleanup log."""
    rows.write.mode("append").parquet(path)


def read_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
