"""CSV landing files into bronze tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


_LOAD = "__load_"


def csv_scan(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    bad_records: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a headered CSV. Without a schema Spark infers the types in an extra pass, and the names are those of the header.

    With a schema its columns are taken by their clean name, wherever they stand in
    the header; other columns of the header are left out, and a declared column that
    is not there is an error. Every file must have the header of the first. In both cases a line with too
    few or too many fields, or with a value not of its type, goes whole into the
    column ``bad_records``; without that argument it ends the job. Nothing is cut off in silence.

    Quoted line breaks need ``multi_line``, which reads each file in one task.
    """
    reader = spark.read.options(header=True, multiLine=multi_line)
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        return _whole_lines(spark, path, inferred.fields, bad_records, multi_line)
    header = reader.csv(path).columns
    declared = {f.name: f.dataType for f in schema}
    names = clean_names(header)
    missing = [c for c in declared if c not in names]
    if missing:
        raise ValueError(f"columns not in the header of {path}: {missing}")
    fields = [StructField(raw, declared.get(c, StringType())) for raw, c in zip(header, names)]
    scanned = _whole_lines(spark, path, fields, bad_records, multi_line)
    kept = [*names, *([bad_records] if bad_records else [])]
    return scanned.toDF(*kept).select(*declared, *kept[len(names) :])


def _whole_lines(spark: SparkSession, path: str, fields: list[StructField], bad_records: str | None, multi_line: bool) -> DataFrame:
    """The fields of the whole header; a line that does not fit them goes into ``bad_records`` or ends the job."""
    reader = spark.read.options(header=True, multiLine=multi_line)
    if bad_records:
        fields = [*fields, StructField(bad_records, StringType())]
        reader = reader.option("columnNameOfCorruptRecord", bad_records)
    else:
        reader = reader.option("mode", "FAILFAST")
    # Lines are held against the whole header, also where few columns are asked for.
    return reader.options(enforceSchema=False, columnPruning=False).schema(StructType(fields)).csv(path)


def clean_name(name: str) -> str:
    """Letters, digits and single underscores; none at either end."""
    return "_".join(re.findall("[A-Za-z0-9]+", name))


def clean_names(names: list[str]) -> list[str]:
    """The clean names in order; two that become one, or one that vanishes, are an error."""
    cleaned = [clean_name(c) for c in names]
    clashes = sorted({n for n in cleaned if cleaned.count(n) > 1 or not n})
    if clashes:
        raise ValueError(f"column names collide or vanish after cleaning: {clashes}")
    return cleaned


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its clean name; two names that become one are an error."""
    return df.toDF(*clean_names(df.columns))


def bronze_load(
    spark: SparkSession,
    files: dict[str, str],
    base: str,
    database: str = "default",
    location: str | None = None,
    schemas: dict[str, StructType] | None = None,
    bad_records: str | None = "corrupt_record",
    multi_line: bool = False,
) -> list[str]:
    """Load each named file below ``base`` and show it under its name, in the place of the load before; returns the names.

    Each load is a table of its own, and the name is a view of the newest, replaced in one step
    once its rows are written: a reader sees the old load or the new one, and a failed
    load leaves the old one. With a ``location`` the loads are folders below it, otherwise
    in the warehouse folder. Older loads stay until ``drop_old_loads``. Malformed lines are kept in ``bad_records``.
    """
    loaded = []
    for name, file_name in files.items():
        raw = csv_scan(spark, f"{base.rstrip('/')}/{file_name}", (schemas or {}).get(name), bad_records, multi_line)
        load = uuid.uuid4().hex[:12]
        target, staged = f"{database}.{name}", f"{database}.{name}{_LOAD}{load}"
        writer = sanitize_columns(raw).write
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{name}/load-{load}")
        writer.saveAsTable(staged)
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {staged}")
        loaded.append(target)
    return loaded


def drop_old_loads(spark: SparkSession, name: str, database: str = "default") -> list[str]:
    """Drop all loads of a name but the one it shows; returns what was dropped. No reader may use them any more."""
    shown = spark.sql(f"SHOW CREATE TABLE {database}.{name}").first()[0]
    loads = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name}{_LOAD}")]
    old = [f"{database}.{t}" for t in loads if t not in shown]
    for table in old:
        spark.sql(f"DROP TABLE {table}")
    return old
