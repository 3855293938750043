import math
import random

import numpy as np
import pytest
from stillwell.llm import neighbours
from stillwell.llm.neighbours import Lists, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, k=20):
    own = {(i, tuple(np.float32(x) for x in v)) for i, v in rows
           if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for i, v in own:
        if i % 20 == 0:
            scores = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), j)
                            for j, w in own if j != i)
            out[i] = [(r + 1, j) for r, (_, j) in enumerate(scores[:k])]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    return {i: sorted(v) for i, v in out.items()}


def test_small_and_awkward_tables(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1, 70)]
    rows += [(100, None), (120, []), (140, [0.0] * 8), (160, [1.0, None] * 4),
             (180, [float("nan")] * 8), (200, [float("inf")] + [0.0] * 7), (None, [1.0] * 8),
             (40, rows[39][1]), (300, [1.0, 2.0])]
    rows += [(i, rows[19][1]) for i in range(400, 460)]  # equal vectors: ties by id
    assert found(nearest(table(spark, rows), "id % 20 = 0")) == brute(rows)


def test_fewer_candidates_than_asked(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert found(nearest(table(spark, rows), "id % 20 = 0")) == {20: [(1, 1), (2, 2)]}
    assert nearest(table(spark, rows[:1]), "id % 20 = 0").collect() == []
    assert nearest(table(spark, []), "id % 20 = 0").collect() == []


@pytest.mark.parametrize("block", [4096, 40])
def test_recall(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "LIST_SIZE", 60)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * 0.4).tolist()) for i in range(1500)]
    want, got = brute(rows), found(nearest(table(spark, rows), "id % 20 = 0"))
    assert set(want) == set(got) and all(len(v) == 20 for v in got.values())
    hit = sum(len({j for _, j in want[i]} & {j for _, j in got[i]}) for i in want)
    assert hit >= 0.9 * 20 * len(want)


def test_lists_are_balanced_and_search_finds_near_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 12))
    lists = Lists(x, float(np.linalg.norm(x, axis=1).max()), 50)
    points = lists.lifted(x)
    ids, far = lists.search(points[:200], 16)
    true = ((points[:200, None] - lists.centroids[None]) ** 2).sum(axis=2)
    assert (ids[:, 0] == true.argmin(axis=1)).mean() > 0.97
    assert np.allclose(np.take_along_axis(true, ids[:, :3], 1), far[:, :3], atol=1e-4)
    parts = []
    lists.halve(points, np.arange(2000), 50, parts, rng)
    assert {len(p) for p in parts} <= {39, 40, 41}
    at, own, primary = lists.homes(x)
    assert primary.sum() == 2000 and np.bincount(at).max() <= neighbours.REPLICAS


def test_all_lists_within_the_ratio_open():
    """Without clusters nearly all lists lie within the ratio, many more than a walk's beam."""
    x = np.random.default_rng(4).normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = Lists(x, float(np.linalg.norm(x, axis=1).max()), 125)
    place, own, primary = lists.homes(x)
    homes = np.zeros((len(x), 125), bool)
    homes[place, own] = True
    opened = np.zeros((100, 125), bool)
    at, own = lists.probes(x[:100], np.bincount(own[primary], minlength=125), 21)
    opened[at, own] = True
    points = np.concatenate([x[:100], np.zeros((100, 1))], axis=1)
    far = np.sqrt(((points[:, None] - lists.centroids[None]) ** 2).sum(axis=2))
    assert not (~opened & (far < 1.349 * far.min(axis=1, keepdims=True))).any()
    near = np.argsort(-x[:100] @ x.T, axis=1)[:, 1:21]
    assert (homes[near] & opened[:, None]).any(axis=2).mean() > 0.999


def test_units_of_lists_are_bounded():
    held = np.array([3, 3, 5, 0, 500, 4, 4])
    assert neighbours.units(held, 4096).tolist() == [0, 0, 1, 1, 2, 3, 3]
    assert neighbours.units(np.full(640, 10), 4096).max() == 63
