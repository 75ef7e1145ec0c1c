import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crispstar.session import prepare  # noqa: E402
from registry.queries import queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def registered(spark):
    """The registered queries over the small tables, each built once."""
    built = {}

    def build(name):
        if name not in built:
            built[name] = queries()[name](spark, SMALL)
        return built[name]

    return build


@pytest.fixture
def settings(spark):
    """Set Spark settings for one test."""
    before = {}

    def set_all(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def rows(df):
    """All rows as tuples, sorted with NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution; runs the query."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)
