"""Tables that keep their versions, on plain Parquet.

A table is a folder with one ``data/version=N`` folder per publish and a ``log``
that gets one row after the data of a version is complete. Readers take the
newest logged version, so a publish is seen whole or not at all, and no path
that is being read is ever overwritten. One writer per table is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

LOG = StructType([StructField("version", IntegerType()), StructField("operation", StringType())])


def _log(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{table}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, table: str) -> int | None:
    log = _log(spark, table)
    return None if log is None else log.agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, table: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{table}/data/version={version}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The newest version."""
    version = current_version(spark, table)
    if version is None:
        raise ValueError(f"no such table: {table}")
    return read_version(spark, table, version)


def publish(
    df: DataFrame,
    table: str,
    mode: str = "create_or_replace",
    operation: str | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """Write ``df`` as the next version and return a scan of it.

    ``create`` refuses an existing table, ``replace`` a missing one. With
    ``partition_by`` each value of that column is a folder; rows are dealt by it, and
    a large partition is split over several tasks. Keep one partitioning per table.
    """
    spark = df.sparkSession
    last = current_version(spark, table)
    if mode not in ("create", "replace", "create_or_replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "create" and last is not None:
        raise ValueError(f"table exists: {table}")
    if mode == "replace" and last is None:
        raise ValueError(f"no such table: {table}")
    version = 0 if last is None else last + 1
    # A version folder without a log row is left over from a failed publish.
    folder = f"{table}/data/version={version}"
    if partition_by:
        df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(folder)
    else:
        df.write.mode("overwrite").parquet(folder)
    entry = [F.lit(version).alias("version"), F.lit(operation or mode).alias("operation")]
    spark.range(1, numPartitions=1).select(*entry).write.mode("append").parquet(f"{table}/log")
    return spark.read.schema(df.schema).parquet(folder).select(*df.columns)


def update_column(df: DataFrame, col: str, expr: Column, where: Column | None = None) -> DataFrame:
    """The table with one column rewritten, for all rows or those that meet ``where``."""
    new = expr if where is None else F.when(where, expr).otherwise(F.col(col))
    return df.withColumn(col, new)


def update_table(
    spark: SparkSession, table: str, col: str, expr: Column, where: Column | None = None
) -> DataFrame:
    """``update_column`` published as the next version of a table."""
    return publish(update_column(read_table(spark, table), col, expr, where), table, "replace", "update")


def snapshot_history(spark: SparkSession, table: str) -> DataFrame:
    """The versions of a table with the operation that made them and their rows, newest first."""
    log = _log(spark, table)
    if log is None:
        raise ValueError(f"no such table: {table}")
    rows = spark.read.parquet(f"{table}/data").groupBy("version").agg(F.count("*").alias("n_rows"))
    history = log.join(rows, "version", "left")
    return history.select(
        "version", "operation", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")
    ).orderBy(F.col("version").desc())


def snapshot_restore(spark: SparkSession, table: str, version: int) -> DataFrame:
    """Make an old version the newest again. Versions in between stay in the history."""
    logged = _log(spark, table)
    if logged is None or logged.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"{table} has no version {version}")
    return publish(read_version(spark, table, version), table, "replace", "restore")
