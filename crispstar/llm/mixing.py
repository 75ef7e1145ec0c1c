"""Mixing sources to target weights, with Spark functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crispstar.llm.common import WORD, identified, text_of, unused
from crispstar.operators.ordered import in_blocks, running_sum
from crispstar.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
# Shards of each source, whatever its size.
REPEATS, BLOCK, SHARDS, SEED = 3, 64, 16, "mix"


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row a source.

    Sources in the order of their code points, NULL last, weigh ``weights`` in
    turn and share all words. A target stops at ``repeats`` times its source; the
    excess goes to the others by weight. A source stops exactly if its limit per
    weight is no more than what the sources with no smaller one could share, so one
    running sum over the sources, in the order of that ratio, settles all.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    limited = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(repeats)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rate = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rated = limited.withColumn("rate", rate).withColumn("stops", F.col("limit") <= F.col("weight") * F.col("rate"))
    # The rate of the first source that does not stop holds for all after it.
    free = F.min(F.when(~F.col("stops"), F.struct(F.col("limit") / F.col("weight"), "rate"))).over(every)["rate"]
    target = F.when(F.col("stops"), F.col("limit")).otherwise(F.col("weight") * free)
    return rated.select("source", "source_size", target.alias("target"))


def apportioned(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the seats of each group dealt by Sainte-Lague to its parties.

    Each seat goes to the highest of ``votes / (2 * seats held + 1)``, ties to the
    party first in order. A divisor that hands out a few seats too few gives what
    all parties surely get; only the quotients next to it are ranked for the
    rest, at most three per party and not one per seat.
    """
    whole = Window.partitionBy(*group)
    total, n = F.sum(votes).over(whole), F.count("*").over(whole)
    share = lambda s: F.floor(F.when(F.col("_t") > 0, F.col(votes) * s / F.col("_t")).otherwise(0.0) + 0.5)
    with_sums = parties.withColumn("_t", total).withColumn("_n", n)
    sure = with_sums.withColumn("_sure", share(F.greatest(F.col(seats) - F.col("_n"), F.lit(0))).cast("long")).withColumn(
        "_most", share(F.col(seats) + F.col("_n")).cast("long")
    )
    rest = sure.withColumn("_rest", F.col(seats) - F.sum("_sure").over(whole))
    next_seats = F.explode(F.sequence(F.col("_sure"), F.greatest("_sure", F.col("_most"))))
    ranked = rest.filter((F.col("_t") > 0) & (F.col(votes) > 0)).select(*group, *party, votes, "_rest", next_seats.alias("_held"))
    best = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("_held") + 1)).desc(), *[F.col(p).asc_nulls_last() for p in party])
    won = ranked.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= F.col("_rest"))
    extra = won.groupBy(*group, *party).agg(F.count("*").alias("_extra"))
    extra = extra.select("_extra", *[F.col(c).alias(f"_of_{c}") for c in group + party])
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group + party]
    return rest.join(extra, on, "left").select(
        *parties.columns, (F.col("_sure") + F.coalesce("_extra", F.lit(0))).alias("quota")
    )


def _drawn(block: Column, blocks: Column, extra: Column, rounds: Column, start: Column) -> Column:
    """How many of the first ``block`` of a shard's blocks are drawn, counting repeats.

    Each block is drawn ``rounds`` times and ``extra`` of them, evenly spaced from a seeded
    start, once more. The product may pass 64 bits, so it is a decimal.
    """
    spaced = F.call_function("div", block.cast("decimal(19,0)") * extra.cast("decimal(18,0)") + start, blocks.cast("decimal(19,0)"))
    return rounds * block + F.when(blocks > 0, spaced - F.call_function("div", start, blocks)).otherwise(0)


def _quotas(sources: DataFrame, weights, repeats: int, block: int, shards: int, seed: str) -> DataFrame:
    """One row per source: ``of_source, source_size, target, before`` (words of the sources before it)``, n`` (blocks)``, rounds``
    and, for each shard, ``first`` block, number of ``blocks``, ``extra`` blocks drawn, draws ``earlier``, and ``start``."""
    aims = targets(sources, weights, repeats)
    all_words = F.sum("target").over(Window.partitionBy("every"))
    seats = aims.withColumn("every", F.lit(0)).withColumn("seats", F.floor(all_words / block + 0.5))
    dealt = apportioned(seats, ["every"], ["source"], "target", "seats")
    before = Window.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size")
    # A source without a block, or smaller than one, is drawn by its target, in blocks of its own words.
    wanted = F.when((F.col("quota") > 0) & (size >= block), (F.col("quota") * block).cast("double")).otherwise(F.col("target"))
    rounds = F.least(F.floor(F.col("wanted") / size), F.lit(repeats)).cast("long")
    rest = F.floor((F.col("wanted") - F.col("rounds") * size) / F.least(size, F.lit(block)) + 0.5)
    per_source = (
        dealt.filter(size > 0).withColumns({"wanted": wanted, "n": F.ceil(size / block)})
        .withColumn("rounds", rounds)
        .withColumn("rest", F.when(F.col("rounds") < repeats, F.least(F.greatest(rest, F.lit(0)), F.col("n"))).otherwise(0).cast("long"))
    )
    per_source = materialize(per_source.select("source", "n", "rounds", "rest"), "source-quotas")
    at = lambda j: F.call_function("div", j * F.col("n"), F.lit(shards))
    streams = per_source.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")).withColumns(
        {"first": at(F.col("shard")), "blocks": at(F.col("shard") + 1) - at(F.col("shard"))}
    )
    start = _number(F.md5(F.concat_ws(":", F.lit(seed), "source", F.col("shard").cast("string")).cast("binary")))
    drawn = apportioned(streams, ["source"], ["shard"], "blocks", "rest").withColumn(
        "start", F.when(F.col("blocks") > 0, start % F.col("blocks")).otherwise(0)
    )
    per_shard = drawn.withColumn("draws", F.col("rounds") * F.col("blocks") + F.col("quota"))
    earlier = F.sum("draws").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shard = F.struct("shard", "first", "blocks", F.col("quota").alias("extra"), F.coalesce(earlier, F.lit(0)).alias("earlier"), "start")
    listed = per_shard.withColumn("_shard", shard).groupBy("source").agg(
        F.sort_array(F.collect_list("_shard")).alias("shards"), F.first("n").alias("n"), F.first("rounds").alias("rounds")
    )
    named = aims.withColumn("before", F.coalesce(F.sum("source_size").over(before), F.lit(0))).withColumnRenamed("source", "of_source")
    return materialize(named.join(listed, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("source"), "quotas")


def _placed(docs: DataFrame, key: str, id_col: str, weights, repeats: int, block: int, shards: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """``row_id, source`` and the words ``upto`` the end of each row in the order of all rows; and the quotas of the sources.

    A source's rows follow each other in a seeded order of their id and text, as part of one order of all rows.
    """
    text = text_of("text")
    digest = F.md5(text.cast("binary"))
    salt = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), digest).cast("binary"))
    sized = materialize(
        docs.select(
            F.col(key).alias("row_id"), "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.unhex(salt).alias("salt")
        ),
        "sized",
    )
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    quotas = _quotas(sources, weights, repeats, block, shards, seed)
    summed = running_sum(in_blocks(sized, ["source", "salt", "size"]), F.col("size"), "upto")
    return summed.select("row_id", "source", "size", "upto"), quotas


def _with_quotas(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """The stretch ``begin, end`` of its source's words that each row fills, with the source's quotas."""
    joined = rows.join(quotas, F.col("source").eqNullSafe(F.col("of_source")))
    return joined.withColumn("end", F.col("upto") - F.col("before")).withColumn("begin", F.col("end") - F.col("size"))


def _number(digest) -> Column:
    """The first seven hex digits of a digest."""
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def _draws(block: Column, shards: int) -> Column:
    """How many of the first ``block`` blocks of a source are drawn, counting repeats: those of earlier shards, and of the one it ends in."""
    # Block b ends in the shard whose blocks, from first on, hold number b - 1.
    j = F.call_function("div", block.cast("decimal(19,0)") * shards - 1, F.col("n").cast("decimal(19,0)")).cast("int")
    at = F.get("shards", j)
    within = _drawn(block - at["first"], at["blocks"], at["extra"], F.col("rounds"), at["start"])
    return F.when(block > 0, at["earlier"] + within).otherwise(0)


def _upto(word: Column, block: int, shards: int) -> Column:
    """Words drawn among the first ``word`` words of the source: of whole blocks, and of the block that it ends in."""
    whole, over = F.call_function("div", word, F.lit(block)), word % block
    drawn = _draws(whole, shards)
    partly = F.when(over > 0, (_draws(whole + 1, shards) - drawn) * over).otherwise(0)
    return drawn * block + partly


def mix(
    docs: DataFrame, id_col: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS,
    block: int = BLOCK, shards: int = SHARDS, seed: str = SEED,
) -> DataFrame:
    """One row per document of ``docs(id, source, text)``: ``id, size, source_size, target, taken``.

    Sizes count words; NULL texts have none and NULL is a source of its own. Each
    source's words, its documents in a seeded order, are cut into blocks of ``block`` words, and
    its blocks into ``shards`` shards, whatever the size of the table. Sainte-Lague deals as
    many blocks as the targets hold to the sources. A source's quota is whole rounds of its words and,
    for the rest, blocks that Sainte-Lague deals to its shards; within a shard they
    are drawn evenly from a seeded start. ``taken`` is how many of the document's words lie
    in drawn blocks, repeats counted, ``repeats`` times its size at most. Ties of
    the order are settled by size, so reruns agree; a source without words
    has a target of 0. An empty table gives no rows; other columns are ignored.

    Only the last block of a source has fewer words, so a source comes within two blocks of
    its target: one of the apportionment, one of that last block. A source below one block is taken in whole
    rounds, to the nearest.
    """
    rows = _with_quotas(*_placed(docs, id_col, id_col, weights, repeats, block, shards, seed))
    taken = F.when(F.col("size") > 0, _upto(F.col("end"), block, shards) - _upto(F.col("begin"), block, shards)).otherwise(0)
    return rows.select(
        F.col("row_id").alias(id_col), "size", "source_size", F.col("target").cast("double").alias("target"), taken.cast("long").alias("taken")
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS,
    block: int = BLOCK, shards: int = SHARDS, seed: str = SEED,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per document and repeat with the words taken in it.

    A repeat that takes all words keeps the text as it is; one that takes some has
    these, joined by one space. Documents of which nothing is taken are left out, and so
    are those without words. Repeated rows are documents of their own; an empty table gives no rows.
    """
    key = unused(docs, "mix_key")
    keyed = identified(docs, id_col, key)
    own = keyed.select(F.col(key).alias("own_key"), *[F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)])
    own_text = F.col(f"own_{[c.lower() for c in docs.columns].index('text')}")
    placed, quotas = _placed(keyed, key, id_col, weights, repeats, block, shards, seed)
    # The quotas of a source, a kilobyte, join last: they are not shuffled with every row.
    rows = own.join(placed.filter(F.col("size") > 0), F.col("own_key") == F.col("row_id"))
    # How often each of the blocks that a document lies in is drawn; its words look it up.
    block_of = lambda word: F.call_function("div", word, F.lit(block))
    spanned = F.sequence(block_of(F.col("begin")), block_of(F.col("end") - 1))
    drawn = F.transform(spanned, lambda b: _draws(b + 1, shards) - _draws(b, shards))
    placed_rows = _with_quotas(rows, quotas).withColumns({"drawn": drawn, "into": F.col("begin") % block}).drop("shards")
    turns = placed_rows.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("rounds").cast("int") + 1)))
    words = F.regexp_extract_all(text_of(own_text), F.lit(WORD), F.lit(0))
    kept = F.filter(words, lambda _, i: F.get("drawn", F.call_function("div", F.col("into") + i, F.lit(block)).cast("int")) >= F.col("turn"))
    text = F.when(F.col("turn") <= F.col("rounds"), own_text).otherwise(F.concat_ws(" ", kept))
    # A drawn block holds a word at least of each document that it touches.
    taken = turns.filter((F.col("turn") <= F.col("rounds")) | F.exists("drawn", lambda n: n >= F.col("turn"))).withColumn("taken_text", text)
    return taken.select(*[F.col("taken_text" if c.lower() == "text" else f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])
