"""Catalog operations: databases, external tables over existing files, partition repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def register_external_parquet(
    spark: SparkSession,
    database: str,
    table: str,
    schema_ddl: str,
    location: str,
    partition_cols: Sequence[str] = (),
) -> str:
    """``CREATE TABLE ... USING parquet PARTITIONED BY ... LOCATION`` then
    ``MSCK REPAIR TABLE`` so partitions already on storage become visible."""
    full = f"{database}.{table}"
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({schema_ddl}) USING parquet{parts} LOCATION '{location}'"
    )
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {full}")
    return full


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
