"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: dirty timestamps carry no zone, so all wall
# clock values are read as UTC; bad text must become NULL through try_*
# functions and never through a silent cast; skewed sort-merge joins are split
# at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The ids a stream remembers are kept on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already owns."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    There is no other: a folder of one machine would be invisible to the other
    executors, so the setting is required under every master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a scan of the result.

    The copy survives lost executors, gives every later use the same rows, and
    lets Catalyst see a real size, so that a join with it is broadcast only
    when the files are small enough and is otherwise an ordinary sort-merge
    join that AQE may split on skew.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Remove what this application has written to the scratch folder; results that still read it must be written first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
