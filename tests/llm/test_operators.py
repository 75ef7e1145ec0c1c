"""Each operator against plain Python, on tables with every awkward row, and on no rows."""

from collections import Counter, defaultdict
from hashlib import sha256
from itertools import product
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from crispstar.llm import bpe, exact_dedup, mixing, simhash, substring_dedup, surrogates, token_shards, topk, toxicity, virtual_slots
from crispstar.llm.components import components
from crispstar.llm.queries import KEY, RANK_END, RANK_PATTERN, vocabulary
from crispstar.session import scratch_path

# Extra columns carry names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, size int, row int, kept int"


def table(spark, texts):
    made = [(i, t, None, s, None, 1, 2, 3, 4) for i, t, s in texts]
    return spark.createDataFrame(made, SCHEMA).repartition(3) if made else spark.createDataFrame([], SCHEMA)


PASSAGE = " ".join(f"p{i}" for i in range(40))
LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))
TEXTS = [
    (1, "one  two\tthree", "a"), (2, "one two three", "b"), (3, None, None), (4, "", "a"), (5, " \n", "c"),
    (6, LONG, "a"), (7, LONG + " x", "a"), (8, f"head {PASSAGE} tail", "b"), (9, f"other {PASSAGE} tail end", "b"),
    (10, f"{PASSAGE} {PASSAGE}", None), (11, "a b c d", "a"), (11, "a b c d", "a"), (11, "else", "c"), (None, "lost", "a"),
    (None, "lost", "a"), (12, "ONE TWO THREE", "b"), (13, " ".join(f"s{i}" for i in range(34)), "a"), (14, "é" * 50 + "   x", "c"),
    (15, " ".join(f"p{i}" for i in range(3, 38)) + " the", "a"), (16, "y " + " ".join(f"p{i}" for i in range(3, 38)) + " the", "a"),
]


def words(text):
    return (text or "").encode().split()


def bag(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_duplicates(docs, counters):
    groups = defaultdict(list)
    for i, t, _ in TEXTS:
        groups[_spaced(t)].append(i)
    want = Counter()
    for text, ids in groups.items():
        ordered = sorted(ids, key=lambda i: (i is None, i or 0))
        for n, i in enumerate(ordered):
            want[i, ordered[0], len(ids), n == 0, sha256(text).hexdigest()] += 1
    got = exact_dedup.exact_duplicates(docs, counters=counters)
    assert bag(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def _spaced(text):
    import re

    return re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())


def test_misra_gries_never_misses_a_frequent_value():
    rng = np.random.default_rng(1)
    for _ in range(20):
        values = [bytes([int(x)]) for x in rng.zipf(1.6, 400) % 40]
        held = {}
        for at in range(0, 400, 50):
            for v, n in Counter(values[at : at + 50]).items():
                held[v] = held.get(v, 0) + n
            held = exact_dedup.shrink(held, 7)
        true = Counter(values)
        assert len(held) <= 7 and all(true[v] >= n >= true[v] - 400 / 8 for v, n in held.items())
        assert all(v in held for v, n in true.items() if n > 400 / 8)


def brute_removed(texts, size):
    starts = Counter(tuple(w[i : i + size]) for w in texts for i in range(len(w) - size + 1))
    kept = []
    for w in texts:
        gone = {j for i in range(len(w) - size + 1) if starts[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept.append([x for j, x in enumerate(w) if j not in gone])
    return kept


def removed_want(texts, size):
    split = [words(t) for _, t, _ in texts]
    kept = brute_removed(split, size)
    return Counter((i, len(w), len(w) - len(k), sha256(b" ".join(k)).hexdigest()) for (i, _, _), w, k in zip(texts, split, kept))


def test_repeated_passages(docs):
    got = substring_dedup.remove_repeated(docs)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == removed_want(TEXTS, 35)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages_of_random_copies(spark, seed):
    rng = np.random.default_rng(seed)
    base = [" ".join(f"v{x}" for x in rng.integers(0, 6, 90)) for _ in range(6)]
    texts = []
    for i in range(120):
        a, b = (base[j].split(" ") for j in rng.integers(0, 6, 2))
        cut, end = rng.integers(0, 60), rng.integers(30, 90)
        mixed = a[cut : cut + end] + b[: rng.integers(0, 60)]
        if rng.random() < 0.5 and mixed:
            mixed[rng.integers(0, len(mixed))] = f"u{rng.integers(0, 3)}"
        texts.append((i, " ".join(mixed), "s"))
    got = substring_dedup.remove_repeated(table(spark, texts))
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == removed_want(texts, 35)


def test_a_given_reference_is_broadcast_in_shards(spark):
    reference = [" ".join(f"r{i}" for i in range(k, k + 30)) for k in (0, 100, 200)]
    texts = [(1, "x " + reference[1] + " y", "a"), (2, "r1 r2 r3", "a"), (3, None, "a")]
    held = spark.createDataFrame([(t,) for t in [*reference, None]], "text string")
    got = substring_dedup.remove_shared(table(spark, texts), held, window=20, shard_words=30)
    assert bag(got, "doc_id", "kept") == Counter([(1, "x y"), (2, "r1 r2 r3"), (3, "")])
    nothing = substring_dedup.remove_shared(table(spark, texts), held.limit(0), window=20)
    assert bag(nothing, "doc_id", "kept") == Counter((i, t or "") for i, t, _ in texts)
    with pytest.raises(ValueError, match="too large"):
        substring_dedup.remove_shared(table(spark, texts), held, most_bytes=10)


def test_equal_rows_do_not_meet_each_other(spark):
    """2,000 equal rows without an id ask one reference: as many pairs as rows."""
    rows = spark.range(2000, numPartitions=4).select(F.lit(None).cast("long").alias("doc_id"), F.lit(" ".join(f"w{i}" for i in range(50))).alias("text"))
    got = substring_dedup.remove_repeated(rows)
    assert got.filter("n_words = 50 AND n_removed = 50").count() == 2000
    asked = rows.select(F.lit(1).cast("long").alias("to"), F.monotonically_increasing_id().alias("p"), F.lit(True).alias("own")).withColumns(
        {"starts": F.array(F.lit(0)), "texts": F.array(F.col("p").cast("string").cast("binary"))}
    )
    made = substring_dedup._match(asked, 35, "pairs")
    assert made.count() == 2000


def test_simhash_components(docs):
    from xxhash import xxh64_intdigest

    def brute(text):
        w = words(text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [brute(t) for _, t, _ in TEXTS]
    root = list(range(len(prints)))
    for _ in prints:
        for i, j in product(range(len(prints)), repeat=2):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[i] = root[j] = min(root[i], root[j])
    ids = defaultdict(list)
    for (i, _, _), r in zip(TEXTS, root):
        ids[r] += [i] if i is not None else []
    want = Counter((i, f"{p:016x}", min(ids[r], default=None)) for (i, _, _), p, r in zip(TEXTS, prints, root))
    assert bag(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == want


def test_bk_trees_and_masks_lose_no_link(spark):
    rng = np.random.default_rng(3)
    values = {int(x) for x in rng.integers(0, 1 << 63, 60)}
    for v in list(values)[:40]:
        for _ in range(3):
            v ^= 1 << int(rng.integers(0, 64)) | 1 << int(rng.integers(0, 64))
            values.add(v)
    values = sorted(values)
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert {tree.values[i] for i in tree.within(v, 2)} == {x for x in values if (x ^ v).bit_count() <= 2}
    signed = [v - (v >> 63 << 64) for v in values]
    got = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")))
    label = {r.node: r.label for r in got.collect()}
    root = {v: v for v in signed}
    for _ in range(12):
        for a, b in product(signed, repeat=2):
            if ((a ^ b) % (1 << 64)).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    assert {v: label.get(v, v) for v in signed} == root


def test_bpe_agrees_with_the_library(docs):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()] += 1
    assert bag(bpe.round_trip(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    own = bpe.ForcedBoundaryEncoder(bpe.read_tokenizer(path))
    odd = ["<|endoftext|>", "a<|startoftext|>b", "ΣΑΣ", "é ́x", "a\x1cb\x85c", "İ ǅ", "日本 ١٢", "it's 'S", "😀👍🏽", "!?—«", "ﬁ K ½", "ÕÎ þ!", "\x00"]
    assert [own.encode(t.encode()) for t in odd] == [library.encode(t, add_special_tokens=False).ids for t in odd]
    assert all(len(own.cut(w)) > 1 for w in ("!z", "q9")) and own.cut("then") == ["then"]


def test_frequent_words_outlast_rare_ones_in_a_cache():
    from crispstar.llm.common import BoundedCache

    made = Counter()
    cache = BoundedCache(lambda key: made.update([key]) or (key,), lambda result: 50, most=20_000)
    for i in range(2000):
        assert cache[b"often"] == (b"often",) and cache[b"%d" % i] == (b"%d" % i,)
        assert len(cache) + len(cache.older) <= 100
    assert made[b"often"] == 1 and len(made) == 2001


def test_pieces_of_a_chunk_agree_with_the_library():
    """Printing ASCII and Latin letters are cut without the library, other text and special tokens with it."""
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.ForcedBoundaryEncoder(bpe.read_tokenizer(path))
    rng = np.random.default_rng(5)
    letters = "aetsrdvmlé'''19$-.<|>Éßÿ×÷µªºñ\u0301\x1c\x7f\u00adİſK"
    chunks = ["".join(rng.choice(list(letters[: rng.choice([18, 22, 99])]), rng.integers(1, 10))) for _ in range(4000)]
    chunks += ["word$$$", "it's", "'tis'S", "A.B@c9.de", "--'s", "x<|endoftext|>'ll", "<|startoftext|>", "Don't.%%%", "10.0.0.1", "ÀÉ***"]
    for c in chunks:
        assert own.encode(c.encode()) == library.encode(c, add_special_tokens=False).ids, c


def test_encoded_rows_decode(docs):
    path = vocabulary("word_bpe_49k.json")
    encoded = bpe.encode_texts(docs.filter("doc_id < 3"), path)
    assert bag(bpe.decode_ids(encoded, path), "text") == Counter({("one</w> two</w> three</w>",): 2})


def test_token_shards_hold_every_text_once(spark, docs):
    import tiktoken

    out = scratch_path(spark, "shards")
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    token_shards.write_shards(docs, out, ranks, RANK_PATTERN, RANK_END, KEY, length=32, least_shards=5)
    read = token_shards.read_shards(spark, out, 32).collect()
    assert sorted(r.slot for r in read) == list(range(len(read)))
    encoding = tiktoken.Encoding("own", pat_str=RANK_PATTERN, mergeable_ranks=token_shards.read_ranks(ranks), special_tokens={})
    want = Counter()
    for i, t, _ in TEXTS:
        ids = [*encoding.encode_ordinary(t or ""), RANK_END]
        want.update((i, p, tuple(ids[a : a + 32])) for p, a in enumerate(range(0, len(ids), 32)))
    assert Counter((r.doc_id, r.part, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in read) == want
    some = token_shards.read_shards(spark, out, 32, 100, 140).collect()
    assert sorted(some) == [r for r in sorted(read) if 100 <= r.slot < 140]
    digest = token_shards.digests(token_shards.read_shards(spark, out, 32, 0, 1)).first()
    first = next(r for r in read if r.slot == 0)
    assert digest.ids_sha256 == token_shards.ids_digest(np.frombuffer(first.ids, "<u2").tolist())


def test_token_shards_are_ranges_of_one_permutation(spark):
    """Slots against plain Python: the order of the permuted numbers, however the table is partitioned."""
    import tiktoken

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=RANK_PATTERN, mergeable_ranks=token_shards.read_ranks(ranks), special_tokens={})
    texts = [(i * 3 - 40, " ".join(f"w{i}x{j}" for j in range(i * 7 % 60)), "s") for i in range(90)]
    most = max(len(t.encode()) for _, t, _ in texts) // 32 + 1
    numbered = []
    for i, t, _ in texts:
        ids = [*encoding.encode_ordinary(t), RANK_END]
        numbered += [((i + 40) * most + p, i, p, ids[a : a + 32]) for p, a in enumerate(range(0, len(ids), 32))]
    places = token_shards.feistel(np.array([x[0] for x in numbered]), (89 * 3 + 1) * most, KEY)
    want = [(i, p, tuple(ids)) for _, (_, i, p, ids) in sorted(zip(places.tolist(), numbered))]
    for n in (1, 7):
        out = scratch_path(spark, "shards")
        token_shards.write_shards(table(spark, texts).repartition(n), out, ranks, RANK_PATTERN, RANK_END, KEY, length=32, least_shards=5)
        read = sorted(token_shards.read_shards(spark, out, 32).collect())
        assert [r.slot for r in read] == list(range(len(want)))
        assert [(r.doc_id, r.part, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in read] == want
        sizes = Counter(r.shard for r in read)
        assert len(sizes) == 5 and max(sizes.values()) < 1.5 * min(sizes.values())


def test_equal_rows_spread_over_token_shards(spark):
    out = scratch_path(spark, "shards")
    rows = spark.range(5000, numPartitions=3).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one same text").alias("text"))
    token_shards.write_shards(rows, out, vocabulary("byte_bpe_50k.tiktoken"), RANK_PATTERN, RANK_END, KEY, length=32, least_shards=10)
    sizes = [r["n_slots"] for r in token_shards.manifest(spark, out, 32).collect()]
    assert len(sizes) == 10 and sum(sizes) == 5000 and max(sizes) < 1.3 * min(sizes)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_keyed_permutation(size):
    one, two = (token_shards.feistel(np.arange(size), size, k) for k in (b"a", b"b"))
    assert sorted(one) == list(range(size)) and (size < 10 or (one != two).any() and (one != np.arange(size)).any())


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(90, 6)).round(1))]
    vectors += [(100 + i, [0.5] * 6) for i in range(20)] + [(7, [0.1] * 6), (None, [1.0] * 6), (200, None), (201, [None, 1.0])]
    vectors += [(202, [float("nan")] * 6), (203, [float("inf")] * 6), (250, []), (300, [1.0, 2.0]), (350, [-1.0, 3.0])]
    schema = "vec_id long, embedding array<float>, rank int, score int, key int"
    df = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in vectors], schema).repartition(4)
    valid = [
        (n, i, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for n, (i, v) in enumerate(vectors)
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    want = Counter()
    for n, i, q in valid:
        if i is not None and i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, c)), j is None, j or 0, j) for m, j, c in valid if m != n and len(c) == len(q)]
            want.update((i, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:5], 1))
    for block_bytes in (1 << 20, 100):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_bytes=block_bytes, bin_bits=4)
        assert bag(got, "query_id", "rank", "vec_id", "score") == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_vectors_of_any_size(spark):
    """Components from 2**18 on are scored exactly beside the others, as queries and as candidates."""
    rng = np.random.default_rng(8)
    sizes = [1.0, 2.0**18, 2.0**30, -(2.0**30), 1e30, -1e30]
    vectors = [(i, [float(x) * sizes[i % 6 if i % 4 == 0 else 0] for x in rng.normal(size=3)]) for i in range(60)] + [(60, [1.5e30] * 3), (61, [1.5e30] * 3)]

    def whole(x):
        return 256 * int(x) if abs(x) >= 2**53 else int(np.floor(256 * x))

    exact = [(i, [whole(x) for x in v]) for i, v in vectors]
    want = Counter()
    for i, q in exact:
        if i % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in exact if j != i)
            want.update((i, r, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, j) in enumerate(scores[:5], 1))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    for block_bytes in (1 << 20, 50):
        assert bag(topk.top_k(df, F.col("vec_id") % 10 == 0, block_bytes=block_bytes), "query_id", "rank", "vec_id", "score") == want


def test_rebalancing_moves_few_slots():
    rng = np.random.default_rng(2)
    weight = {i: int(x) for i, x in enumerate(rng.integers(50, 150, 800))}
    first = virtual_slots.rebalanced({i: i % 16 for i in weight}, weight, 16)
    weight[3] *= 20
    second = virtual_slots.rebalanced(first, weight, 16)
    load = Counter()
    for i, s in second.items():
        load[s] += weight[i]
    assert max(load.values()) - min(load.values()) <= 2 and sum(first[i] != second[i] for i in weight) < 120


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    out, free, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total >= 3 * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over


def test_mixing(spark, docs):
    sizes = Counter()
    for _, t, s in TEXTS:
        sizes[s] += len(words(t))
    got = mixing.mix(docs, block=8).collect()
    targets = brute_targets(sizes)
    source = Counter((i, len(words(t)), sizes[s], round(targets[s], 6)) for i, t, s in TEXTS)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == source
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken = Counter()
    for r in got:
        taken[r.source_size] += r.taken
    assert all(abs(taken[sizes[s]] - t) <= 16 for s, t in targets.items())
    assert Counter(got) == Counter(mixing.mix(docs.repartition(7), block=8).collect())
    mixed = mixing.mixed(docs, block=8)
    assert mixed.columns == docs.columns
    per_row = Counter()
    for r in mixed.collect():
        per_row[r.doc_id] += len(words(r.text))
    want = Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert +per_row == +want


def test_small_sources_of_a_large_table_come_near_their_targets(spark):
    rows = spark.range(100_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 200 == 0, "small").when(F.col("id") % 3 == 0, "void").otherwise("big").alias("source"),
        F.when(F.col("id") % 200 == 0, F.repeat(F.lit("w "), 12)).when(F.col("id") % 3 > 0, F.repeat(F.lit("w "), 30)).alias("text"),
    )
    got = mixing.mix(rows).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    share = {r.source_size: r.taken / r.target for r in got if r.source_size}
    assert sorted(r.n for r in got) == [500, 33_167, 66_333] and len(share) == 2
    assert all(0.98 < s < 1.02 for s in share.values()), share


def test_sainte_lague(spark):
    rng = np.random.default_rng(4)
    for seats in (0, 1, 7, 100, 1001):
        votes = [int(x) for x in rng.integers(0, 500, 9)]
        df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, p int, v double, s long")
        held = [0] * 9
        for _ in range(seats):
            best = max(range(9), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
            held[best] += 1
        got = mixing.apportioned(df, ["g"], ["p"], "v", "s").orderBy("p").collect()
        assert [r.quota for r in got] == held


def test_toxicity_learns_from_positives_and_unlabelled_text(spark):
    rng = np.random.default_rng(6)
    clean = [f"w{i}e" for i in range(400)]
    clean = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in clean]
    bad = ["zquirp", "zquonk", "vlort"]
    texts, toxic = [], {}
    for i in range(1500):
        text = list(rng.choice(clean, rng.integers(5, 60)))
        if i % 7 == 0:
            text[:2] = rng.choice(bad, 2)
        toxic[i] = int(i % 7 == 0)
        texts.append((i, " ".join(text), "s"))
    docs = table(spark, [*texts, (9001, None, None), (9002, "", None), (None, "zquirp vlort", "s"), (9003, "zquirp " * 20_000, "s")])
    labels = spark.createDataFrame([(i, 0, t) for i, t in toxic.items() if i % 3] + [(None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.held_out_toxicity(docs, labels).collect()}
    assert len(got) == 1504 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (i is not None and crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in toxic if got[i].held_out]
    assert np.mean([got[i].predicted == toxic[i] for i in held]) > 0.97
    assert got[9001].score == got[9002].score < 0.5 and got[9003].predicted == 1 and got[None].predicted == 1
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.predicted}
    unlabelled = toxicity.held_out_toxicity(docs.limit(5), labels.limit(0)).collect()
    assert [r.predicted for r in unlabelled] == [0] * 5


def test_toxicity_of_long_texts_needs_more_than_chance_features():
    from xxhash import xxh64_intdigest

    weak, strong = [f"wk{chr(97 + i)}x" for i in range(20)], ["zquirp", "vlort"]
    features = [xxh64_intdigest(f"w{w}".encode()) >> 1 for w in weak + strong]
    model = toxicity.Model(features, np.array([[0.6]] * 20 + [[9.0]] * 2), np.array([-5.0]))
    for n in (2_000, 20_000, 200_000):
        clean = ["plain"] * n
        clean[:: n // 20] = [weak[i % 20] for i in range(len(clean[:: n // 20]))]
        text = " ".join(clean).encode()
        assert model.score(text) < 0.5 and model.score(text.replace(b" ", b",")) < 0.5
        clean[n // 2 : n // 2 + 2] = strong
        assert model.score(" ".join(clean).encode()) > 0.5
        assert model.score(b"vlort plain " * (n // 2)) > 0.9
    assert model.score(" ".join(weak).encode()) > 0.5 and model.score(b"") == model.score(b"plain " * 900) < 0.01


def test_surrogates(spark):
    one = "Mail jo.72@mail3.example.com, call +1 (234) 567-8901, 169.122.221.182, 4111 1111 1111 1111. Mrs Anna Müller and г-н Иван Петров."
    two = "JO.72@MAIL3.EXAMPLE.COM or 1 234 567 8901; Frau Anna Müller; b44e15e09fd311c3cf3163b66d5a9875b883d8ce"
    many = [(10 + i, f"a{i % 10}@b.example.com x", "s") for i in range(60)]
    docs = table(spark, [(1, one, "a"), (2, two, "b"), (3, None, None), (4, "", "a"), (5, "no 1 here", "a"), (5, two, "a"), (None, one, "a"), *many])
    got = defaultdict(list)
    for r in surrogates.replace_personal(docs, b"k").collect():
        got[r.doc_id].append(r)
        assert r.text_sha256 == sha256((r.text or "").encode()).hexdigest()
    assert (got[3][0].text, got[4][0].text, got[5][0].n_entities + got[5][1].n_entities) == (None, "", 4)
    first, second = got[1][0].text, got[2][0].text
    assert got[None][0].text == first and second in [r.text for r in got[5]]
    for secret in ("jo.72", "567-8901", "169.122", "4111 1111 1111 1111", "Müller", "Петров"):
        assert secret not in first
    found_one, found_two = ({k: (v, first[a:b]) for a, b, k, v in surrogates.entities(t)} for t in (first, second))
    assert found_one["email"][0] == found_two["email"][0] and found_one["phone"][0] == found_two["phone"][0]
    assert found_one["person-f"][0] == found_two["person-f"][0] and surrogates._luhn(found_one["card"][0]) == 0
    given = found_one["person-f"][0].split()[0]
    assert given in surrogates.GIVEN["latin", "f"] and found_one["person-m"][0].split()[0] in surrogates.GIVEN["cyrillic", "m"]
    replaced = [got[10 + i][0].text for i in range(60)]
    assert len(set(replaced)) == 10 and all(replaced[i] == replaced[i % 10] for i in range(60))
    assert not {t.split()[0] for t in replaced} & {f"a{i}@b.example.com" for i in range(10)}


def test_surrogates_take_whole_names_and_follow_them(spark):
    texts = [
        "Ms Anna-Maria Weber met Mr. J. Smith.", "Mr. John Ronald Smith came. Later Mr. Smith sat; John and SMITH's dog left.",
        "Señor Gabriel García Márquez", "Mr O'Brien’s car", "Dr. Anna Weber", "Frau Prof. Dr. Eva von der Leyen-Meier", "г-н И. Петров. Петров ушёл", "Monsieur d'Artagnan",
        "Smith is no name here", "Mr. X",
    ]
    got = {r.doc_id: r for r in surrogates.replace_personal(table(spark, [(i, t, "s") for i, t in enumerate(texts)]), b"k").collect()}
    new = [got[i].text for i in range(len(texts))]
    for secret in ("Anna", "Maria", "Weber", "J. ", "John", "Ronald", "Gabriel", "García", "Márquez", "Brien", "Eva", "Leyen", "Meier", "И.", "Петров", "Artagnan", "X"):
        assert not any(secret in t for t in new), secret
    assert [got[i].n_entities for i in range(len(texts))] == [2, 4, 1, 1, 1, 1, 2, 1, 0, 1] and new[8] == texts[8]
    given, middle, family = new[1].split(" ")[1:4]
    assert new[1] == f"Mr. {given} {middle} {family} came. Later Mr. {family} sat; {given} and {family.upper()}'s dog left."
    anna, weber = new[4].split(" ")[1:]
    assert new[0].startswith(f"Ms {anna}-") and f" {weber} met Mr. " in new[0] and new[0].endswith(f". {family}.") and anna.lower() in surrogates.GIVEN["latin", "f"]
    assert new[3].endswith("’s car") and new[5].startswith("Frau Prof. Dr. ") and " von der " in new[5] and new[7].startswith("Monsieur d'")


def test_usual_forms_of_numbers_are_found(spark):
    forms = ["+15551234567", "5551234567", "+4930123456", "+33 6 12 34 56 78", "06 12 34 56 78", "555-1234", "+1 (234) 567-8901"]
    kinds = [("phone", f) for f in forms] + [("national", "123-45-6789"), ("ipv6", "2001:db8::ff00:42:8329"), ("ipv6", "fe80:0:0:0:0:0:0:1")]
    kinds += [("card", "3782 822463 10005"), ("card", "378282246310005"), ("ip", "10.20.30.40")]
    for kind, form in kinds:
        assert [(f"see {form}, now"[a:b], k) for a, b, k, _ in surrogates.entities(f"see {form}, now")] == [(form, kind)]
    for plain in ("on 2024-01-15", "on 01.02.2020", "pi 3.1415926", "at 12:30:45", "a 1234567 b", "std::vector", "12 15 18 22"):
        assert not list(surrogates.entities(plain)), plain
    assert [k for *_, k, _ in surrogates.entities("+1 (843) 555-7672 170.1.2.33 and +15551234567 4111 1111 1111 1111")] == ["phone", "ip", "phone", "card"]
    got = surrogates.replace_personal(table(spark, [(i, f"see {f}, now", "s") for i, (_, f) in enumerate(kinds)]), b"k").collect()
    assert all(r.n_entities == 1 and kinds[r.doc_id][1] not in r.text and len(r.text) >= 10 for r in got) and len(got) == len(kinds)


def test_initials_never_stay_and_never_meet():
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя"):
        new = [surrogates.initial(c, b"k") for c in letters]
        assert sorted(new) == list(letters) and all(a != b for a, b in zip(new, letters))


def test_surrogates_stay_distinct_where_forms_run_out(spark):
    values = spark.createDataFrame([("email", f"{a}@example.org") for a in "abcdefghijklmnopqrstuvwxyz"], "kind string, value string")
    got = surrogates.assigned(values, b"k").collect()
    new = {r.surrogate for r in got}
    assert len(new) == len(got) == 26 and not new & {r.value for r in got}


def test_no_rows(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = scratch_path(spark, "none")
    token_shards.write_shards(none, out, vocabulary("byte_bpe_50k.tiktoken"), RANK_PATTERN, RANK_END, KEY)
    for got in (
        token_shards.read_shards(spark, out), surrogates.replace_personal(none, KEY), exact_dedup.exact_duplicates(none),
        substring_dedup.remove_repeated(none), toxicity.held_out_toxicity(none, labels), bpe.round_trip(none, vocabulary("word_bpe_49k.json")),
        simhash.simhash_components(none), virtual_slots.shard_by_slots(none, scratch_path(spark, "map")), mixing.mix(none), mixing.mixed(none),
    ):
        assert got.count() == 0
