"""Toxicity from confirmed toxic examples and unlabelled text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from crispstar.llm.common import BoundedCache, in_arrow, raw, sliced
from crispstar.session import materialize

# Bounds of what the model is fitted on: documents of each kind, and word features.
POSITIVES, UNLABELLED, FEATURES = 6_000, 12_000, 2_048
LEAST_SUPPORT, LEAST_RATIO = 4, 3.0
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE_BYTES = 64 << 20
# Evidence is weighed over windows of two stretches of so many words.
STRETCH = 128


def word_features(chunk: bytes) -> tuple[int, ...]:
    """Hashes of the words in a chunk of text, and of their first three to six letters."""
    return tuple([f for word in _LETTERS.findall(chunk.decode("utf-8", "replace").lower()) for f in _of_word(word)])


def _of_word(word: str) -> list[int]:
    return [xxh64_intdigest(f.encode()) >> 1 for f in ("w" + word, *[f"{n}{word[:n]}" for n in range(3, 7) if len(word) > n])]


def nn_pu_fit(x: np.ndarray, positive: np.ndarray, prior: float, seed: int = 0, epochs: int = 40, rate: float = 0.03) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by non-negative positive-unlabelled learning.

    The risk is ``prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)])`` with the
    sigmoid loss ``l``: what positives hidden in the unlabelled rows add is taken off by
    the class prior. Where that estimate falls below zero, the step goes the other way.
    Weights stay at 0 or above: every feature was chosen as evidence for toxicity, and a
    group of copies in the unlabelled rows must not turn one into evidence against it.
    """
    rng = np.random.default_rng(seed)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    w, b = np.zeros(x.shape[1]), -1.0
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    batches = max(1, len(u) // 512)
    for _ in range(epochs):
        for up, uu in zip(np.array_split(rng.permutation(p), batches), np.array_split(rng.permutation(u), batches)):
            if not len(up):
                up = rng.choice(p, 8)
            xp, xu = x[up].astype(np.float64), x[uu].astype(np.float64)
            sp, su = _sigmoid(xp @ w + b), _sigmoid(xu @ w + b)
            dp, du = sp * (1 - sp), su * (1 - su)
            clean = su.mean() - prior * sp.mean()  # l(-z) is the sigmoid of z
            up_u, up_p = du / len(uu), prior * dp / len(up)
            if clean >= 0:
                gu, gp = up_u, -2 * up_p
            else:
                gu, gp = -up_u, up_p
            grad = np.append(xu.T @ gu + xp.T @ gp + 1e-5 * w, gu.sum() + gp.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = np.maximum(w - step[:-1], 0), b - step[-1]
    return w, float(b)


def _hits_bytes(made: tuple[int, tuple]) -> int:
    return 120 + 100 * len(made[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Model:
    """The mean of some linear classifiers over the presence of word features in windows of a text.

    Chance features add up with the length of a text, so a classifier sees two stretches
    of ``STRETCH`` words at a time, each stretch with the next. The odds of a text are the
    mean odds of its windows: a long text needs evidence in many windows or much of it in
    one, and the whole text counts. A text of one stretch is one window.
    """

    def __init__(self, features: list[int], weights: np.ndarray, biases: np.ndarray):
        self.at = {f: i for i, f in enumerate(features)}
        self.weights, self.biases = weights, biases
        self.known = BoundedCache(self._words, _hits_bytes, _CACHE_BYTES)

    def _words(self, chunk: bytes) -> tuple[int, tuple[tuple[int, tuple[int, ...]], ...]]:
        """How many words a chunk has, and the place and feature numbers of those that have any."""
        words = _LETTERS.findall(chunk.decode("utf-8", "replace").lower())
        hits = [(n, tuple([self.at[f] for f in _of_word(word) if f in self.at])) for n, word in enumerate(words)]
        return len(words), tuple([h for h in hits if h[1]])

    def present(self, text: bytes) -> tuple[int, dict[int, set[int]]]:
        """How many words a text has, and the numbers of the features of each stretch that has any."""
        known, found, at = self.known, {}, 0
        for chunk in text.split():
            seen = known[chunk]
            for n, hits in seen[1]:
                found.setdefault((at + n) // STRETCH, set()).update(hits)
            at += seen[0]
        return at, found

    def score(self, text: bytes) -> float:
        words, found = self.present(text)
        if not found:
            return float(_sigmoid(self.biases).mean())
        begins = sorted({b for s in found for b in (s, max(s - 1, 0))})
        z = np.array([self.weights[sorted(found.get(b, set()) | found.get(b + 1, set()))].sum(axis=0) for b in begins])
        most = z.max(axis=0)
        windows = max(words / STRETCH, len(begins))
        odds = (np.exp(z - most).sum(axis=0) + (windows - len(begins)) * np.exp(-most)) / windows
        return float(_sigmoid(np.log(odds) + most + self.biases).mean())


def _sample(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """At most ``n`` different ids, the same in each run."""
    return ids.distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES, prior: float | None = None,
) -> Model:
    """A model from at most ``positives`` documents labelled toxic and ``unlabelled`` others, whose labels are not used.

    Only rows for which ``usable`` (over ``doc_id``) holds are looked at. The class
    prior is the share of toxic ones among the usable labels unless it is given. The
    ids of the sample are broadcast; its features are counted by Spark, and those that
    positives have far more often than other text, at most ``features``, reach the driver.
    Without a positive or unlabelled document the model scores everything 0.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(usable & F.col("toxic").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, labelled = marked.agg(F.sum("toxic"), F.count("*")).first()
    if prior is None:
        prior = min(max((toxic or 0) / max(labelled, 1), 1e-3), 0.5)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = named.select("doc_id").filter(usable & F.col("doc_id").isNotNull())
    chosen_p = _sample(marked.filter("toxic = 1").select("doc_id"), positives, 1)
    chosen = materialize(
        _sample(ids, unlabelled, 2).withColumn("positive", F.lit(False)).unionByName(chosen_p.withColumn("positive", F.lit(True))),
        "sample-ids",
    )

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for part in sliced(batch, "text"):
            for i, positive, text in zip(part.column("doc_id").to_pylist(), part.column("positive").to_pylist(), raw(part, "text")):
                yield i, positive, sorted({f for chunk in set(text.split()) for f in word_features(chunk)})

    sampled = in_arrow(named.join(F.broadcast(chosen), "doc_id"), rows, "doc_id long, positive boolean, features array<long>", 500)
    # An id that many rows share is one example, whatever its rows are.
    sample = materialize(sampled.groupBy("doc_id", "positive").agg(F.min("features").alias("features")), "sample")
    n_u, n_p = (sample.filter(x).count() for x in ("not positive", "positive"))
    empty = Model([], np.zeros((0, 1)), np.full(1, -1e3))
    if not n_u or not n_p:
        return empty
    in_p, in_u = F.col("in_p") / n_p, (F.col("in_u") + 1) / n_u
    counted = (
        sample.select("positive", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if("positive").alias("in_p"), F.count_if(~F.col("positive")).alias("in_u"))
        .filter((F.col("in_p") >= LEAST_SUPPORT) & (in_p > LEAST_RATIO * in_u))
    )
    chosen_features = [r[0] for r in counted.orderBy((in_p * F.log(in_p / in_u)).desc(), "feature").limit(features).collect()]
    if not chosen_features:
        return empty
    model = Model(chosen_features, np.zeros((0, 1)), np.zeros(1))
    at = spark.sparkContext.broadcast(model.at)

    def numbers(batch: pa.RecordBatch) -> Iterable[tuple]:
        for positive, found in zip(batch.column("positive").to_pylist(), batch.column("features").to_pylist()):
            yield positive, [at.value[f] for f in found if f in at.value]

    known = in_arrow(sample, numbers, "positive boolean, features array<int>").collect()
    known = sorted(known, key=lambda r: (r["positive"], r["features"]))
    x, positive = np.zeros((len(known), len(chosen_features)), np.uint8), np.array([r["positive"] for r in known])
    for i, r in enumerate(known):
        x[i, r["features"]] = 1
    fitted = [nn_pu_fit(x, positive, prior, seed) for seed in range(3)]
    return Model(chosen_features, np.array([w for w, _ in fitted]).T, np.array([b for _, b in fitted]))


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: ``id, score`` (0 to 1)``, predicted`` (1 from 0.5 on).

    NULL and empty texts get the score of a text without any feature. NULL ids and
    repeated rows are scored like any other row; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for part in sliced(batch, "text"):
            scores = [sent.value.score(t) for t in raw(part, "text")]
            yield from zip(part.column("id").to_pylist(), scores, [int(s >= 0.5) for s in scores])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return in_arrow(read, rows, "id long, score double, predicted int", 2000).withColumnRenamed("id", id_col)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def held_out_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every document, learnt from the documents that are not held out.

    Held out are those with a ``fold`` of 0; a NULL id is not. An empty table gives no rows.
    """
    model = fit(docs, labels, fold("doc_id") != 0, id_col, text_col)
    scored = toxicity(docs, model, id_col, text_col)
    return scored.select(F.col(id_col), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, all their columns as they are.

    NULL and empty texts stay; repeated rows are scored alike, so all go or all stay; an empty table gives no
    rows. Columns may have any name but those of ``id_col`` and ``text_col`` twice. A batch is filtered by a mask: nothing
    but the texts, a slice at a time, becomes a Python value.
    """
    model = fit(docs, labels, fold("doc_id") != 0, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text_col):
                yield part.filter(pa.array([sent.value.score(t) < 0.5 for t in raw(part, text_col)], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
