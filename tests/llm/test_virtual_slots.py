"""Virtual slots and their stored map against plain Python."""

from collections import Counter, defaultdict
from zlib import crc32

from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from crispstar.llm import virtual_slots
from crispstar.session import scratch_path
from tests.llm.test_operators import TEXTS, table


def slot_of(text, slots=4096):
    seed = xxh64_intdigest(virtual_slots._SEED.to_bytes(4, "little"), 42)
    h = xxh64_intdigest((text or "").encode(), seed)
    return (h - (h >> 63 << 64)) % slots


def many(spark, n, every=3):
    text = F.when(F.col("id") % every == 0, "copy").otherwise(F.concat(F.lit("t"), F.md5(F.col("id").cast("string"))))
    return spark.range(n, numPartitions=4).select(F.col("id").alias("doc_id"), text.alias("text"))


def loads(rows):
    return [r["b"] for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]


def test_rows_stand_where_the_stored_map_says(spark):
    path = scratch_path(spark, "map")
    got = virtual_slots.shard_by_slots(table(spark, TEXTS), path).collect()
    want = Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode()), slot_of(t)) for i, t, _ in TEXTS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.virtual_slot) for r in got) == want
    stored = virtual_slots.read_map(spark, path).collect()
    owner = defaultdict(set)
    for r in stored:
        owner[r.virtual_slot].add(r.shard)
    assert all(r.shard in owner[r.virtual_slot] and r.map_version == 2 for r in got) and len(owner) == 4096
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert Counter(r.shard for r in virtual_slots.read_map(spark, path, 1).collect()) == dict.fromkeys(range(16), 256)


def test_equal_texts_stay_together_and_hot_ones_are_cut(spark):
    rows = virtual_slots.shard_by_slots(many(spark, 20_000), scratch_path(spark, "map"))
    even = loads(rows)
    assert len(even) == 16 and max(even) - min(even) < 0.01 * max(even)
    # A small text that shares the slot of the hot one is not torn apart with it.
    beside = next(f"x{i}" for i in range(100_000) if slot_of(f"x{i}") == slot_of("copy"))
    pair = spark.createDataFrame([(i, beside) for i in range(50_000, 50_020)], "doc_id long, text string")
    mixed = virtual_slots.shard_by_slots(many(spark, 20_000).unionByName(pair), scratch_path(spark, "map"))
    spread = mixed.groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).filter("n > 1").collect()
    assert [r["text_crc32"] for r in spread] == [crc32(b"copy")]


def test_copies_without_an_id_or_with_one_spread(spark):
    for lost in (F.lit(None).cast("long"), F.lit(7).cast("long")):
        copies = spark.range(5000, numPartitions=3).select(lost.alias("doc_id"), F.lit("the same").alias("text"))
        even = loads(virtual_slots.shard_by_slots(copies, scratch_path(spark, "map")))
        assert len(even) == 16 and sum(even) == 45_000 and max(even) < 1.4 * min(even)


def test_a_grown_table_moves_few_rows(spark):
    path = scratch_path(spark, "map")
    before = virtual_slots.shard_by_slots(many(spark, 18_000), path).select("doc_id", F.col("shard").alias("was")).cache()
    before.count()
    after = virtual_slots.shard_by_slots(many(spark, 20_000), path)
    assert {r["map_version"] for r in after.select("map_version").distinct().collect()} == {3}
    even = loads(after)
    assert max(even) - min(even) < 0.01 * max(even)
    moved = before.join(after, "doc_id").filter("was <> shard").count()
    assert moved < 0.05 * 18_000, moved
