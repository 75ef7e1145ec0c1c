"""Landing files and versioned tables."""

import pytest
from pyspark.sql import functions as F

from crispstar import session
from crispstar.sources import landing, tables
from crispstar.sources.schemas import ORDERS, PRODUCTS
from tests.conftest import rows


@pytest.fixture
def numbers(spark):
    return spark.range(10).select(F.col("id"), (F.col("id") * 2).alias("twice"))


def test_names(spark):
    assert [landing.clean_name(n) for n in ["device_id(s)", " a--b ", "_x__y_", "ok1"]] == [
        "device_id_s", "a_b", "x_y", "ok1"
    ]
    with pytest.raises(ValueError, match="a_b"):
        landing.sanitize_columns(spark.sql("SELECT 1 AS `a b`, 2 AS `a_b`"))
    with pytest.raises(ValueError):
        landing.sanitize_columns(spark.sql("SELECT 1 AS `()`"))


def test_csv_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b(s)\n1, x\nfive,\n")
    inferred = landing.csv_scan(spark, str(tmp_path / "x.csv"))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["string", "string"]
    assert rows(inferred) == [("1", " x"), ("five", None)]
    names = landing.bronze_load(spark, {"loaded_x": "x.csv"}, str(tmp_path))
    again = landing.bronze_load(spark, {"loaded_x": "x.csv"}, str(tmp_path))
    assert names == again == ["default.loaded_x"]
    assert spark.table("loaded_x").columns == ["a", "b_s", "corrupt_record"]
    assert spark.table("loaded_x").count() == 2
    assert len(landing.drop_old_loads(spark, "loaded_x")) == 1 and landing.drop_old_loads(spark, "loaded_x") == []
    assert spark.table("loaded_x").count() == 2
    drop(spark, "loaded_x")


def drop(spark, name):
    spark.sql(f"DROP VIEW {name}")
    for t in spark.catalog.listTables():
        if t.name.startswith(f"{name}__load_"):
            spark.sql(f"DROP TABLE {t.name}")


def test_no_field_is_lost_without_a_schema(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("n,day\n1,2024-01-01\n2,2024-01-02,more\n3\n4,2024-01-04\n")
    got = landing.csv_scan(spark, str(path), bad_records="bad")
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "date", "string"]
    assert [(r["n"], r["bad"]) for r in sorted(got.collect())] == [(1, None), (2, "2,2024-01-02,more"), (3, "3"), (4, None)]
    assert rows(got.select("n").filter("n > 3")) == [(4,)]
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.csv_scan(spark, str(path)).collect()
    names = landing.bronze_load(spark, {"loaded_s": "s.csv"}, str(tmp_path))
    assert spark.table(names[0]).filter("corrupt_record is not null").count() == 2
    drop(spark, "loaded_s")


def test_explicit_schema_needs_no_inference_job(spark, tmp_path):
    (tmp_path / "o.csv").write_text(",".join(ORDERS.names) + "\n" + ",".join("abcdefgh") + "\n")
    assert landing.csv_scan(spark, str(tmp_path / "o.csv"), ORDERS).schema == ORDERS


def test_columns_are_taken_by_name_and_bad_lines_kept(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('category,product id,product_name,price,extra\ntoys,P1,"Car\nred",5,x\ntoys,P2,Bus,6,x,y\ntoys,P3\n')
    schema = PRODUCTS
    got = landing.csv_scan(spark, str(path), schema, "bad", multi_line=True)
    assert got.columns == [*schema.names, "bad"]
    by_id = {r.product_id: r for r in got.collect()}
    assert tuple(by_id["P1"]) == ("P1", "Car\nred", "toys", "5", None)
    assert by_id["P2"].product_name == "Bus" and "toys,P2,Bus,6,x,y" in by_id["P2"].bad
    assert by_id["P3"].category == "toys" and by_id["P3"].price is None and by_id["P3"].bad is not None
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.csv_scan(spark, str(path), schema, multi_line=True).collect()
    path.write_text("category,product_id,product_name,price,extra\ntoys,P2,Bus,6,x,y\ntoys,P4,Van,7,x\n")
    one_line = landing.csv_scan(spark, str(path), schema, "bad").select("product_id", "bad")
    assert rows(one_line) == [("P2", "toys,P2,Bus,6,x,y"), ("P4", None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.csv_scan(spark, str(path), schema).select("product_id").collect()
    path.write_text("category,product_id,price\n")
    with pytest.raises(ValueError, match="product_name"):
        landing.csv_scan(spark, str(path), schema)


def test_every_file_has_the_same_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("category,product_id,product_name,price\ntoys,P1,Car,5\n")
    (folder / "b.csv").write_text("product_id,category,product_name,price\nP2,toys,Bus,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.csv_scan(spark, str(folder), PRODUCTS, "bad").collect()


def test_a_failed_load_leaves_the_old_table(spark, tmp_path):
    (tmp_path / "y.csv").write_text("product_id,product_name,category,price\nP1,Car,toys,5\n")
    load = lambda **more: landing.bronze_load(
        spark, {"loaded_y": "y.csv"}, str(tmp_path), location=str(tmp_path / "t"), schemas={"loaded_y": PRODUCTS}, **more
    )
    load()
    (tmp_path / "y.csv").write_text("product_id,product_name,category,price\nP1,Car,toys,5,6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load(bad_records=None)
    assert rows(spark.table("loaded_y")) == [("P1", "Car", "toys", "5", None)]
    load()
    assert spark.table("loaded_y").first()["corrupt_record"] == "P1,Car,toys,5,6"
    drop(spark, "loaded_y")


def test_modes(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no such table"):
        tables.publish(numbers, path, "replace")
    with pytest.raises(ValueError, match="no such table"):
        tables.read_table(spark, path)
    tables.publish(numbers, path, "create")
    with pytest.raises(ValueError, match="exists"):
        tables.publish(numbers, path, "create")
    with pytest.raises(ValueError, match="mode"):
        tables.publish(numbers, path, "append")
    tables.publish(numbers.filter("id < 3"), path)
    assert rows(tables.read_table(spark, path)) == [(0, 0), (1, 2), (2, 4)]


def test_versions_can_be_read_changed_and_restored(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(numbers, path, "create")
    # The new version is computed from the table it replaces.
    tables.update_table(spark, path, "twice", F.col("twice") + 1, where=F.col("id") < 5)
    assert rows(tables.read_table(spark, path))[:2] == [(0, 1), (1, 3)]
    assert dict(rows(tables.read_table(spark, path)))[7] == 14
    tables.snapshot_restore(spark, path, 0)
    assert rows(tables.read_table(spark, path)) == rows(numbers)
    with pytest.raises(ValueError, match="no version 9"):
        tables.snapshot_restore(spark, path, 9)
    assert [tuple(r) for r in tables.snapshot_history(spark, path).collect()] == [
        (2, "restore", 10), (1, "update", 10), (0, "create", 10)
    ]


def test_a_failed_publish_leaves_the_table_alone(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(numbers, path, "create")
    broken = numbers.withColumn("twice", F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise(F.col("twice")))
    with pytest.raises(Exception, match="boom"):
        tables.publish(broken, path)
    # A complete folder without a log row is a publish that died in between.
    numbers.limit(1).write.mode("overwrite").parquet(f"{path}/data/version=1")
    assert tables.read_table(spark, path).count() == 10
    assert tables.snapshot_history(spark, path).count() == 1
    tables.publish(numbers.filter("id < 4"), path)
    assert tables.read_table(spark, path).count() == 4
    assert tables.current_version(spark, path) == 1


def test_empty_versions_are_listed(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(numbers.filter("id < 0"), path, "create")
    assert tables.read_table(spark, path).count() == 0
    assert [tuple(r) for r in tables.snapshot_history(spark, path).collect()] == [(0, "create", 0)]


def test_scratch_folder_is_the_configured_one(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
