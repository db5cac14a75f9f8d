"""Readers: CSV (inferred / explicit / permissive), JSON lines, Parquet, catalog tables.

Paths are any Hadoop URI (local, HDFS, object stores); nothing here is specific to a
file system. Production jobs should pass explicit schemas: inference reads the data
an extra time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header; schema inferred unless given."""
    r = spark.read.option("header", str(header).lower())
    if options:
        r = r.options(**options)
    if schema is None:
        r = r.option("inferSchema", "true")
    else:
        r = r.schema(schema)
    return r.csv(path)


def read_csv_permissive(
    spark: SparkSession,
    path: str,
    schema: StructType,
    corrupt_column: str | None = None,
) -> DataFrame:
    """PERMISSIVE CSV: a malformed cell becomes null and the row is kept.

    With ``corrupt_column`` the raw text of malformed rows is kept in that column
    (it is added to the schema as a string).
    """
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = StructType(list(schema.fields)).add(corrupt_column, "string")
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines (one document per line); nested schema inferred unless given."""
    r = spark.read.option("multiLine", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet; partition directories (``k=v``) become columns."""
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
