import math
import random

import numpy as np
import pytest
from stillwell.llm import hard_negatives as op
from stillwell.llm.hard_negatives import Bucket, allowed, hard_negatives, unit

SCHEMA = ("vec_id long, embedding array<double>, label int, key long, bucket long, "
          "id string, length int, least double, n int")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 0.5, 4) for r in rows], SCHEMA)


def brute(rows, positive=5, negative=5, least=80, most=100):
    seen = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(
                c is None or not math.isfinite(256 * c) for c in x):
            continue
        ints = tuple(math.floor(256 * c) for c in x)
        if math.hypot(*ints) < 2 ** 31:
            seen[i, ints, label] = None
    own = list(seen)
    out = []
    for i, x, label in own:
        if i % 10:
            continue
        scores = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, y, other in own if j != i)
        for p, j, _ in [s for s in scores if s[2] == label][:positive]:
            found = [(n, k) for n, k, other in scores if other != label
                     and least * -p <= 100 * -n <= most * -p][:negative]
            out += [(i, j, r, k, -p, -n) for r, (n, k) in enumerate(found, 1)]
    return sorted(out)


def check(spark, rows, **more):
    made = hard_negatives(table(spark, rows), "id % 10 = 0", **more).collect()
    assert sorted(tuple(r) for r in made) == brute(rows, **more)
    return made


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(op, "SMALLEST", 7)
    monkeypatch.setattr(op, "LARGEST", 7)
    monkeypatch.setattr(op, "RUN", 2)
    monkeypatch.setattr(op, "ASKED", 3)


def clustered(rng, n, labels=3, width=6):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = rng.randrange(labels)
        near = centres[rng.choice([label, rng.randrange(labels)])]
        size = rng.choice([0.2, 1, 5])
        out.append((i, [size * (c + rng.gauss(0, 0.2)) for c in near], label))
    return out


def test_equals_brute_force(spark, small):
    check(spark, clustered(random.Random(1), 150))


def test_awkward_rows(spark, small):
    rng = random.Random(2)
    rows = clustered(rng, 60)
    rows += [(i, [1.0] * 6, 0) for i in range(100, 125)]  # copies of one vector
    rows += [(i, [1.0] * 6, 1) for i in range(125, 140)]
    rows += [(200, None, 1), (201, [], 0), (210, [], 1), (202, [None, 1.0], 0), (203, [1.0], None),
             (None, [1.0] * 6, 0), (204, [float("nan")] * 6, 1), (205, [math.inf, 1.0], 1),
             (220, [0.0] * 6, 0), (221, [-0.001, 0.5], 1), (206, [1e300] * 6, 0),
             (230, [3.2e6] * 6, 2), (231, [3.1e6] * 6, 2), (232, [2.9e6] * 6, 0),
             (233, [9e6] * 6, 2), rows[10], rows[10],
             (240, [-1.0] * 6, 9), (241, [1.0] * 6, 9), (250, [1.0] * 6, 7),
             (20, [0.5, 0.5], 1)]
    made = check(spark, rows)
    assert any(r["positive_score"] > 2 ** 61 for r in made)


def test_other_bounds(spark, small):
    check(spark, clustered(random.Random(3), 80, labels=2), positive=2, negative=3, least=50, most=110)


def test_one_label_gives_nothing(spark):
    assert check(spark, [(i, [1.0, i / 9], 4) for i in range(30)]) == []


def test_empty_table(spark):
    assert hard_negatives(table(spark, []), "id % 10 = 0").collect() == []


def test_no_anchor(spark):
    assert hard_negatives(table(spark, [(1, [1.0], 0), (2, [1.0], 1)]), "id % 10 = 0").collect() == []


def bucket_of(x):
    order = np.argsort(unit(x), axis=0, kind="stable").astype(np.uint16)
    return Bucket(range(len(x)), [0] * len(x), x.tobytes(), x.shape[1], np.ascontiguousarray(
        order.T).tobytes())


@pytest.mark.parametrize("spread", [0.05, 0.3, 3.0])
def test_pruning_loses_nothing_and_prunes_clusters(spread):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20, 16))[rng.integers(0, 20, 2000)] + spread * rng.normal(size=(2000, 16))
    # Lengths hardly differ within a bucket.
    x *= rng.uniform(900, 1000, (2000, 1)) / np.sqrt((x ** 2).sum(axis=1, keepdims=True))
    x = np.floor(x).astype(np.int32)
    x[:3] = 0
    bucket, asks = bucket_of(x), x[::50]
    lengths = np.sqrt((asks.astype(float) ** 2).sum(axis=1))
    scores = asks.astype(np.int64) @ x.T.astype(np.int64)
    least = np.sort(scores, axis=1)[:, -20].astype(float)
    kept = 0
    for i, (ask, found) in enumerate(zip(asks, bucket.fitting(unit(asks), lengths, least))):
        wanted = set(np.flatnonzero(scores[i] >= least[i]).tolist())
        assert found is None or least[i] <= 0 or wanted <= set(found.tolist())
        kept += len(x) if found is None else len(found)
    assert spread > 0.05 or kept < 0.4 * len(asks) * len(x)
    for i, places, made in bucket.scores(asks, lengths, least):
        assert (made == scores[i][places]).all()


def test_allowed_scores():
    for score in (-7, -1, 0, 1, 4, 5, 99, 10 ** 18 + 3):
        lo, hi = allowed(score, 80, 100)
        for n in {lo - 1, lo, lo + 1, hi - 1, hi, hi + 1}:
            assert (lo <= n <= hi) == (80 * score <= 100 * n <= 100 * score)
