"""The whole pipeline, and its dropping stages, against plain Python."""

import re
from collections import Counter, defaultdict
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crispstar.llm import exact_dedup, mixing, simhash, toxicity
from crispstar.llm.queries import vocabulary
from tests.llm.test_operators import brute_targets

CLASHES = ["score", "predicted", "text_", "id_", "dedup_key", "near_key", "mix_key", "row_key", "own_text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)


def words(text):
    return (text or "").encode().split()


def made():
    rng = np.random.default_rng(11)
    clean = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    texts = []
    for i in range(420):
        said = list(rng.choice(clean, rng.integers(5, 70)))
        if i % 6 == 0:
            said[:3] = rng.choice(["zquirp", "zquonk", "vlort"], 3)
        texts.append(" ".join(said))
    rows = [(i, t, f"s{i % 4}" if i % 9 else None) for i, t in enumerate(texts)]
    long = " ".join(rng.choice(clean, 4000))
    rows += [(500, texts[1] + "  ", "s1"), (501, texts[1].replace(" ", "\t"), "s0"), (502, texts[2] + ",", "s2"), (2, "another text of id two", "s2")]
    rows += [(503, None, "s1"), (504, "", None), (505, " \n", "s1"), (None, "lost text one", "s1"), (None, "lost text two", None), (506, long, "s3"), (507, long + " end", "s1")]
    rows += [(508, "twice the same row", "s1")] * 2
    labels = [(i, 0, int(i % 6 == 0)) for i in range(420) if i % 4] + [(None, 0, 1), (9999, 1, None)]
    return rows, labels


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, *range(len(CLASHES))) for i, t, s in rows], SCHEMA)


def order(r):
    return (r[0] is None, r[0] or 0)


def first_of_equal(rows):
    kept = {}
    for r in sorted(rows, key=order):
        kept.setdefault(re.sub(rb"[\x20\x09-\x0D]+", b" ", (r[1] or "").encode()), r)
    return list(kept.values())


def first_of_near(rows):
    prints = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = top[i], top[j]
                top = [min(a, b) if t in (a, b) else t for t in top]
    groups = defaultdict(list)
    for r, t in zip(rows, top):
        groups[t].append(r)
    return [min(g, key=order) for g in groups.values()]


def apportioned(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if votes[i]), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
        held[best] += 1
    return held


def brute_mix(rows):
    """Texts and how often each of their words is taken, by counting the draws of every block."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    listed = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = brute_targets(sizes)
    quotas = dict(zip(listed, apportioned([targets[s] for s in listed], int(sum(targets.values()) / 64 + 0.5))))
    out = []
    for s in listed:
        size, n = sizes[s], -(-sizes[s] // 64)
        if not size:
            continue
        wanted = quotas[s] * 64 if quotas[s] and size >= 64 else targets[s]
        rounds = min(int(wanted // size), 3)
        rest = 0 if rounds == 3 else min(max(int((wanted - rounds * size) / min(size, 64) + 0.5), 0), n)
        bounds = [j * n // 16 for j in range(17)]
        draws = []
        for j, extra in enumerate(apportioned([b - a for a, b in zip(bounds, bounds[1:])], rest)):
            blocks = bounds[j + 1] - bounds[j]
            start = int(md5(":".join(["mix", *([s] if s is not None else []), str(j)]).encode()).hexdigest()[:7], 16) % max(blocks, 1)
            draws += [rounds + (start + (b + 1) * extra) // blocks - (start + b * extra) // blocks for b in range(blocks)]
        at = 0
        salted = [(md5(f"mix:{'null' if i is None else i}:{md5((t or '').encode()).hexdigest()}".encode()).digest(), len(words(t)), i, t) for i, t, x in rows if x == s]
        for _, _, i, t in sorted(salted, key=lambda r: r[:2]):
            taken = [draws[(at + k) // 64] for k in range(len(words(t)))]
            at += len(taken)
            for turn in range(1, rounds + 1):
                if taken:
                    out.append((i, t))
            kept = b" ".join(w for w, d in zip(words(t), taken) if d > rounds)
            if kept:
                out.append((i, kept.decode()))
    return out


def encoded(pairs):
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = Counter()
    for i, t in pairs:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out[i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()] += 1
    return out


def test_run(spark, tmp_path):
    rows, labels = made()
    frame(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    read = [spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "labels")]
    model = toxicity.fit(*read, toxicity.fold("doc_id") != 0)
    left = [r for r in rows if model.score((r[1] or "").encode()) < 0.5]
    assert len(rows) - 75 < len(left) < len(rows) - 60
    want = encoded(brute_mix(first_of_near(first_of_equal(left))))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


def test_run_over_nothing(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_keep_whole_rows(spark):
    """What stays has all its columns and values, also those that bear the names that operators use."""
    rows, labels = made()
    docs = frame(spark, rows).repartition(3).cache()
    all_rows = bag(docs.collect())
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for stage, keep in ((exact_dedup.drop_exact_duplicates, first_of_equal), (simhash.drop_near_duplicates, None)):
        got = stage(docs)
        assert got.columns == docs.columns and not bag(got.collect()) - all_rows
        if keep:
            assert Counter((r.doc_id, r.text and " ".join(r.text.split())) for r in got.collect() if r.doc_id not in (503, 504, 505)) == Counter(
                (i, t and " ".join(t.split())) for i, t, _ in keep(rows) if i not in (503, 504, 505)
            )
    left = toxicity.drop_toxic(docs, labelled)
    assert left.columns == docs.columns and not bag(left.collect()) - all_rows
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and {tuple(r)[5:] for r in mixed.collect()} == {tuple(range(len(CLASHES)))}


def test_near_duplicates_keep_the_first(spark):
    rows = [r for r in made()[0] if r[0] is not None and r[0] not in (2, 508)]
    got = simhash.drop_near_duplicates(frame(spark, rows).repartition(3))
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in first_of_near(rows))


@pytest.mark.parametrize("n", [5000])
def test_mixing_of_equal_rows_without_an_id(spark, n):
    """Equal rows are cut into blocks like any others, and each source is met within two of its blocks."""
    rows = spark.range(n, numPartitions=4).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 50, "b").otherwise("a").alias("source"), F.lit("w " * 30).alias("text"))
    got = mixing.mix(rows).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(got) == 2 and all(abs(r.taken - r.target) <= 128 for r in got)


def test_a_source_below_a_block_is_taken(spark):
    rows = spark.createDataFrame([(1, "a", "w " * 12), (2, "b", "x " * 4000), (3, "c", "y " * 900)], "doc_id long, source string, text string")
    got = {r.source_size: (r.target, r.taken) for r in mixing.mix(rows).collect()}
    assert got[12] == (36.0, 36) and sum(len(words(r.text)) for r in mixing.mixed(rows).filter("source = 'a'").collect()) == 36


def test_the_sample_is_bounded_in_rows(spark):
    """Ids that many rows share are one example each, and the sample holds no more than its bounds."""
    text = F.concat(F.lit("zquirp w"), F.col("id") % 50)
    docs = spark.range(3000, numPartitions=4).select((F.col("id") % 5).alias("doc_id"), text.alias("text"))
    labels = spark.createDataFrame([(0, 0, 1), (1, 0, 1), (2, 0, 1), (3, 0, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True), positives=5, unlabelled=5)
    assert len(model.at) <= toxicity.FEATURES
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
