"""Catalog tables: create, replace, append, list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it is there; its tables lie at `location`, or in the session's warehouse."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create the table from the rows, or replace it."""
    df.write.mode("overwrite").partitionBy(*partition_by).format("parquet").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name; columns the rows lack must not exist in the table."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")
