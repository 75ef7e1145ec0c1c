"""Adding a batch to a table."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crispstar.operators.uniqueness import dedup_by_key
from crispstar.session import materialize


def incremental_load(
    current: DataFrame, batch: DataFrame, key: str, order_by: list | None = None, newest_by: str | None = None
) -> DataFrame:
    """Upsert: keys of the batch replace their rows, other rows stay; NULL is a key of its own.

    Within the batch the first row by ``order_by`` wins. With ``newest_by`` the row
    with the largest value there wins over both sides, so that a late batch does not
    undo a newer row; NULL is oldest, and of equals the batch wins. The winners are written
    once: while they are small the current table is only filtered by a broadcast
    of their keys and never shuffled, beyond that it is a sort-merge join that
    AQE may split.
    """
    newest = [F.col(newest_by).desc_nulls_last()] if newest_by else []
    winners = materialize(dedup_by_key(batch, key, [*newest, *(order_by or [])]), "batch")
    same = F.col(key).eqNullSafe(F.col("_key"))
    replaced = winners.select(F.col(key).alias("_key"))
    kept = current.join(replaced, same, "left_anti")
    if newest_by:
        before = current.join(replaced, same, "left_semi").withColumn("_from_batch", F.lit(0))
        rivals = before.unionByName(winners.withColumn("_from_batch", F.lit(1)))
        winners = dedup_by_key(rivals, key, [*newest, F.col("_from_batch").desc()]).drop("_from_batch")
    return kept.unionByName(winners)


def load_partitions(
    spark: SparkSession, path: str, batch: DataFrame, key: str, partition_by: str, newest_by: str | None = None
) -> None:
    """``incremental_load`` into a Parquet table, rewriting only partitions that the batch has rows for or takes keys from.

    A key that comes with another partition leaves the old one; which partitions hold keys of the
    batch is read from the key column alone. A partition that loses all its rows is removed. What
    passes through the driver is the names of the partitions touched.

    The new partitions are written beside the table first and logged as ready, then put in the place of the old
    ones. Should that fail halfway, ``recover_partitions`` does it again, and so does the next load. One writer
    per table is assumed; a reader may meanwhile see a partition without its files.
    """
    recover_partitions(spark, path, batch.schema, partition_by)
    # The type that the batch has, not the one that folder names suggest.
    table = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
    keys = materialize(batch.select(F.col(key).alias("_key")).distinct(), "batch-keys")
    held = table.select(key, partition_by).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(partition_by)
    values = {row[0] for row in batch.select(partition_by).unionByName(held).distinct().collect()}
    named = F.col(partition_by).isin([v for v in values if v is not None])
    touched = named | F.col(partition_by).isNull() if None in values else named
    current = table.filter(touched)
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    whole = spark.read.schema(batch.schema).parquet(path)
    folders = {r[0]: r[1] for r in whole.filter(touched).select(partition_by, folder).distinct().collect()}
    load = uuid.uuid4().hex[:12]
    merged = incremental_load(current, batch, key, newest_by=newest_by)
    merged.write.parquet(f"{path}/_pending/load-{load}")
    left = {r[0] for r in spark.read.schema(batch.schema).parquet(f"{path}/_pending/load-{load}").select(partition_by).distinct().collect()}
    _note(spark, path, load, [unquote(f) for v, f in folders.items() if v not in left])
    recover_partitions(spark, path, batch.schema, partition_by)


_NOTES = "load string, emptied array<string>, applied boolean"


def _note(spark: SparkSession, path: str, load: str, emptied: list[str], applied: bool = False) -> None:
    spark.createDataFrame([(load, emptied, applied)], _NOTES).coalesce(1).write.mode("append").parquet(f"{path}/_pending/notes")


def recover_partitions(spark: SparkSession, path: str, schema: StructType, partition_by: str) -> list[str]:
    """Put the loads that are ready, but not noted as applied, in the place of the partitions they replace; returns them.

    Doing so again changes nothing.
    """
    try:
        notes = spark.read.schema(_NOTES).parquet(f"{path}/_pending/notes").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    applied = {n["load"] for n in notes if n["applied"]}
    ready = [n for n in notes if not n["applied"] and n["load"] not in applied]
    for note in ready:
        rows = spark.read.schema(schema).parquet(f"{path}/_pending/load-{note['load']}")
        writer = rows.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        for folder in note["emptied"]:
            _remove(spark, folder)
        _note(spark, path, note["load"], [], True)
        _remove(spark, f"{path}/_pending/load-{note['load']}")
    return [n["load"] for n in ready]


def _remove(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
