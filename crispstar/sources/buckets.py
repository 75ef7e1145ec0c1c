"""Tables that are bucketed and sorted by a key, so that they meet on it without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` files, each sorted by ``key``, and return a scan of it.

    Tables with the same number of buckets of the same key are joined on it, and each is grouped by it, without
    an exchange of their rows. One bucket holds all rows of a key: buckets pay for
    joins that repeat, on keys without hot values. The table must not exist.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table).select(*df.columns)
