"""Upserts into relational tables (PostgreSQL dialect).

Executors write a micro-batch to a staging table side by side; one statement then merges it. Both
steps may be repeated, so a retried micro-batch leaves the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from receiptflow.operators.latest import latest_per_key
from receiptflow.schemas import Record
from receiptflow.sinks.stream import with_retries

# SQL types of the tables.
SQL_TYPES = {
    T.StringType(): "VARCHAR",
    T.DoubleType(): "DOUBLE PRECISION",
    T.IntegerType(): "INTEGER",
    T.TimestampType(): "TIMESTAMP",
}


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    batch_rows: int = 1000
    retries: int = 5
    connections: int = 16  # most connections that write at once

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "dbtable": table,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
            "fetchsize": str(self.batch_rows),
            "isolationLevel": "READ_COMMITTED",
        }

    def parts(self, key: str) -> list[str]:
        """Conditions that cut a table into as many parts as there are connections, by a hash of its key."""
        of = f"abs(hashtext({key}::varchar)::bigint) % {self.connections}"
        return [f"{of} = {i}" if i else f"({of} = 0 OR {key} IS NULL)" for i in range(self.connections)]


def create_sql(record: Record) -> str:
    columns = [
        f"{f.column} {SQL_TYPES[f.type]}" + (" PRIMARY KEY" if f.column == record.key else "") for f in record.fields
    ]
    return f"CREATE TABLE IF NOT EXISTS {record.table} ({', '.join(columns)})"


def merge_sql(record: Record, staging: str) -> str:
    """Insert the staged rows; a row whose key exists replaces all columns (the last write wins)."""
    names = ", ".join(record.columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in record.columns if c != record.key)
    return (
        f"INSERT INTO {record.table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({record.key}) DO UPDATE SET {updates}"
    )


def _instance(spark: SparkSession, name: str):
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.loadClass(name).newInstance()


def execute(spark: SparkSession, target: JdbcTarget, statement: str) -> None:
    """Run one statement on the database from the driver."""
    jvm = spark._jvm
    # The session's own class loader, as the driver may have come with the job and not with Spark.
    driver = _instance(spark, target.driver)
    login = jvm.java.util.Properties()
    login.setProperty("user", target.user)
    login.setProperty("password", target.password)
    connection = driver.connect(target.url, login)
    try:
        handle = connection.createStatement()
        try:
            handle.execute(statement)
        finally:
            handle.close()
    finally:
        connection.close()


def ensure_tables(spark: SparkSession, target: JdbcTarget, records: list[Record], run: Callable = execute) -> None:
    """Create the missing tables. Call it before any query starts, so that no insert comes first."""
    for record in records:
        run(spark, target, create_sql(record))


def stage(df: DataFrame, target: JdbcTarget, table: str) -> None:
    # Dealt out anew, so that few connections do not make few tasks of the step before.
    df = df.repartition(target.connections)
    df.write.format("jdbc").options(**target.options(table)).mode("overwrite").save()


def upsert(record: Record, target: JdbcTarget, name: str, run: Callable = execute, put: Callable = stage):
    """A ``foreachBatch`` function that upserts rows with an ``arrival`` into the record's table.

    ``name`` and a random part tell apart the staging tables of queries and jobs that run at the same
    time; each is overwritten by every micro-batch. One merge must not
    meet a key twice, so only the last arrival of each key is staged; rows without key are left out,
    as the primary key cannot take them.
    """
    staging = f"receiptflow_stage_{name}_{uuid.uuid4().hex[:12]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*record.columns, "arrival").filter(f"{record.key} IS NOT NULL")
        put(latest_per_key(rows, record.key, "arrival").drop("arrival"), target, staging)
        run(batch.sparkSession, target, merge_sql(record, staging))

    return with_retries(write, target.retries)


def read_table(spark: SparkSession, target: JdbcTarget, record: Record, view: str | None = None) -> DataFrame:
    """A stored table, ready for SQL under ``view`` (default: the table's name)."""
    options = target.options(record.table)
    login = {k: options[k] for k in ("user", "password", "driver", "fetchsize")}
    table = spark.read.jdbc(target.url, record.table, predicates=target.parts(record.key), properties=login)
    table.createOrReplaceTempView(view or record.table)
    return table
