"""The toxicity classifier against its definition in plain Python."""

import math
import re

import numpy as np
from xxhash import xxh64_intdigest

from crispstar.llm import toxicity


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-500, min(500, z))))


def risk(w, b, x, positive, prior):
    """The non-negative risk with the sigmoid loss, summed one row at a time."""
    z = [sum(wi * xi for wi, xi in zip(w, row)) + b for row in x]
    as_positive = [sigmoid(-v) for v, p in zip(z, positive) if p]
    as_clean = [sigmoid(v) for v, p in zip(z, positive) if p]
    unlabelled = [sigmoid(v) for v, p in zip(z, positive) if not p]
    clean = sum(unlabelled) / len(unlabelled) - prior * sum(as_clean) / len(as_clean)
    return prior * sum(as_positive) / len(as_positive) + max(0.0, clean)


def test_the_fit_comes_near_the_least_risk():
    rng = np.random.default_rng(3)
    positive = np.arange(900) < 300
    truly = positive | (rng.random(900) < 0.2)  # a fifth of the unlabelled rows are positive too
    x = np.stack([rng.random(900) < np.where(truly, 0.9, 0.02), rng.random(900) < 0.3], axis=1).astype(np.uint8)
    w, b = toxicity.nn_pu_fit(x, positive, 0.2, epochs=1500)
    grid = [(a, c, d) for a in (0, 2, 4, 8, 16) for c in (0, 1) for d in (-8, -4, -2, -1, 0)]
    least = min(risk((a, c), d, x.tolist(), positive, 0.2) for a, c, d in grid)
    assert (w >= 0).all() and risk(w, b, x.tolist(), positive, 0.2) <= least + 0.02
    assert w[0] > 4 * w[1] and sigmoid(w[0] + b) > 0.5 > sigmoid(w[1] + b)


def brute_features(word):
    return [xxh64_intdigest(f.encode()) >> 1 for f in ["w" + word] + [f"{n}{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]]


def brute_score(text, features, weights, biases):
    """Mean over classifiers of the sigmoid of the log of the mean odds of the windows, two stretches each."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    stretches = [set() for _ in range(math.ceil(max(len(words), 1) / 128))]
    for i, word in enumerate(words):
        stretches[i // 128].update(f for f in brute_features(word) if f in features)
    begins = {b for s, held in enumerate(stretches) if held for b in (s, max(s - 1, 0))}
    n = max(len(words) / 128, len(begins))
    out = []
    for k in range(len(biases)):
        if not begins:
            out.append(sigmoid(biases[k]))
            continue
        odds = sum(math.exp(sum(weights[features.index(f)][k] for f in stretches[b] | (stretches[b + 1] if b + 1 < len(stretches) else set()))) for b in begins)
        out.append(sigmoid(math.log((odds + n - len(begins)) / n) + biases[k]))
    return sum(out) / len(out)


def test_scores_by_definition():
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefg"), rng.integers(2, 9))) for _ in range(60)] + ["Größe", "слово"]
    features = sorted({f for w in vocabulary[:20] for f in brute_features(w.lower())})
    weights, biases = rng.random((len(features), 3)) * 2, np.array([-3.0, -4.0, -2.5])
    model = toxicity.Model(features, weights, biases)
    texts = ["", " \n", "12 34", "a_b-c,d", "Größe слово x1y"] + [" ".join(rng.choice(vocabulary, n)) for n in (1, 5, 127, 128, 129, 700)]
    texts += [" ".join(["other"] * 900 + [vocabulary[0]]), ",".join(rng.choice(vocabulary, 300))]
    for text in [*texts, *texts]:  # once more from the cache
        assert math.isclose(model.score(text.encode()), brute_score(text, features, weights, biases), rel_tol=1e-9)
    assert model.known.size <= model.known.most and all(len(k) <= model.known.longest for k in model.known)


def test_the_cache_is_bounded_by_bytes():
    from crispstar.llm.common import BoundedCache

    cache = BoundedCache(len, lambda made: 50, most=10_000)
    for i in range(1000):
        assert cache[f"word {i}"] == len(f"word {i}") and cache.size <= 10_000
    assert cache["x" * 65] == 65 and "x" * 65 not in cache and len(cache) < 60
