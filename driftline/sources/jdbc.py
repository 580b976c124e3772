"""Relational targets over JDBC. The driver jar is the session's business."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

@dataclass(frozen=True)
class Connection:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}

    def __repr__(self) -> str:
        return f"Connection(url={self.url!r}, user={self.user!r}, password='****')"


def connection(address: str, keep_query: bool = True) -> Connection:
    """Connection of `postgresql://user:password@host/db`; `keep_query` keeps what follows a `?`.

    User and password may be percent-encoded.
    """
    parts = urlsplit(address)
    host = parts.netloc.rpartition("@")[2]
    if parts.scheme != "postgresql" or not parts.username or not parts.password or not host:
        raise ValueError("expected postgresql://user:password@host:port/database")
    query = f"?{parts.query}" if keep_query and parts.query else ""
    return Connection(f"jdbc:postgresql://{host}{parts.path}{query}", unquote(parts.username), unquote(parts.password))


def read_table(
    spark: SparkSession, conn: Connection, table: str, split_on: str | None = None,
    low: int | None = None, high: int | None = None, partitions: int | None = None,
) -> DataFrame:
    """Read a table, in parallel ranges of `split_on` where its bounds are given."""
    reader = spark.read.format("jdbc").options(**conn.options(), dbtable=table)
    if split_on:
        if low is None or high is None or partitions is None:
            raise ValueError("split_on needs low, high and partitions")
        reader = reader.options(
            partitionColumn=split_on, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return reader.load()


def append_table(df: DataFrame, conn: Connection, table: str, batch_size: int = 1000, connections: int = 16) -> None:
    """Append rows over `connections` connections at most. Running it again appends them again."""
    options = {"dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}
    df.write.format("jdbc").options(**conn.options(), **options).mode("append").save()


def staging_name(table: str) -> str:
    return f"temp_{table}_{uuid.uuid4().hex[:12]}"


def write_staging(df: DataFrame, conn: Connection, table: str, staging: str | None = None) -> str:
    """Write rows to a new staging table and return its name."""
    staging = staging or staging_name(table)
    df.write.format("jdbc").options(**conn.options(), dbtable=staging).mode("overwrite").save()
    return staging


def load_through_staging(
    df: DataFrame, conn: Connection, table: str, key: Sequence[str], json_columns: Sequence[str] = (), update: bool = False
) -> int:
    """Stage the rows, move them by `insert_from_staging_sql`, drop the staging table in any case; the rows moved.

    Runs again without harm, since existing keys are skipped or overwritten.
    """
    staging = staging_name(table)
    try:
        write_staging(df, conn, table, staging)
        return _execute(df.sparkSession, conn, insert_from_staging_sql(table, staging, df.columns, key, json_columns, update))
    finally:
        _execute(df.sparkSession, conn, f"DROP TABLE IF EXISTS {staging}")


def _execute(spark: SparkSession, conn: Connection, statement: str) -> int:
    """One statement from the driver, where the JDBC driver must be on the class path; rows it changed."""
    link = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(conn.url, conn.user, conn.password)
    try:
        return link.createStatement().executeUpdate(statement)
    finally:
        link.close()


def insert_from_staging_sql(
    table: str, staging: str, columns: Sequence[str], key: Sequence[str], json_columns: Sequence[str] = (), update: bool = False
) -> str:
    """Statement that moves staged rows into the table.

    Rows with an existing key are left alone, or overwritten with `update`.
    """
    picked = ", ".join(f"{c}::jsonb" if c in json_columns else c for c in columns)
    changed = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in key)
    action = f"UPDATE SET {changed}" if update else "NOTHING"
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) SELECT {picked} FROM {staging} "
        f"ON CONFLICT ({', '.join(key)}) DO {action}"
    )
