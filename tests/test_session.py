"""The scratch folder."""

import subprocess
import sys
from pathlib import Path

from tests.conftest import SMALL


def test_scratch_is_removed_on_request(tmp_path):
    """In an application of its own, so that no other test loses its tables."""
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / 'shared')!r}).getOrCreate()
from crispstar.session import clear_scratch, materialize, scratch_dir
assert materialize(spark.read.parquet({SMALL + '/nation.parquet'!r}), "kept").count() == 25
assert clear_scratch(spark) and not clear_scratch(spark)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)
    assert not list((tmp_path / "shared").glob("local-*"))
