import random

import numpy as np
import pytest
from data import documents, prose
from stillwell.llm.common import documents as narrow
from stillwell.llm.mixing import domains_of, mixed_rates, mixing

MARK = {"good": "alpha", "poor": "beta", "toxic": "gamma"}


def corpus(n=240):
    rng, rows, labels = random.Random(1), [], []
    for i in range(n):
        kind = ("good", "good", "poor", "toxic")[i % 4]
        rows.append((i, prose(rng, rng.randint(20, 60)) + f" {MARK[kind]}" * 15))
        if i % 3:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("weights", [{"good": 0.6, "poor": 0.3, "toxic": 0.1},
                                     {"good": 1, "poor": 1, "toxic": 0}])
def test_targets_are_met(spark, weights):
    rows, labels = corpus()
    made = mixing(documents(spark, rows), labelled(spark, labels), weights).collect()
    total = sum(r["n_tokens"] for r in made)
    assert len(made) == len(rows) and all(r["rate"] >= 0 for r in made)
    for kind, weight in weights.items():
        held = sum(r["rate"] * r["n_tokens"] * r["posterior"][kind] for r in made)
        assert held / total == pytest.approx(weight / sum(weights.values()), abs=0.01)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in made)
    assert sum(r["copies"] * r["n_tokens"] for r in made) == pytest.approx(total, rel=0.15)


def test_nothing_is_lost_with_a_least_rate(spark):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (1002, "alpha " * 20000), (5, rows[5][1]), (None, "beta")]
    labels += [(None, 1, 1), (3, None, None)]
    made = mixed_rates(narrow(documents(spark, rows)), domains_of(labelled(spark, labels)),
                       {"good": 0.6, "poor": 0.2, "toxic": 0.2}, least=1.0).collect()
    assert len(made) == len(rows) and all(r["rate"] >= 1 and r["copies"] >= 1 for r in made)


def test_without_labels_or_rows(spark):
    rows, labels = corpus(12)
    made = mixing(documents(spark, rows), labelled(spark, [])).collect()
    assert {r["rate"] for r in made} == {1.0} and {r["copies"] for r in made} == {1}
    assert mixing(documents(spark, []), labelled(spark, labels)).collect() == []


def rare(n=1000):
    """A poor domain of 0.3 % of the rows."""
    rng = random.Random(2)
    rows = [(i, prose(rng, 40) + f" {MARK['good' if i % 333 else 'poor']}" * 40)
            for i in range(1, n)]
    return rows, [(i, int(i % 333 != 0), 0) for i, _ in rows]


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_rare_domains_meet_their_targets(spark, least):
    rows, labels = rare()
    made = mixed_rates(narrow(documents(spark, rows)), domains_of(labelled(spark, labels)),
                       {"good": 0.85, "poor": 0.15}, least=least).collect()
    held = {k: sum(r["rate"] * r["tokens"] * r["posterior"][k] for r in made)
            for k in ("good", "poor")}
    assert all(r["rate"] >= least for r in made)
    assert held["poor"] / sum(held.values()) == pytest.approx(0.15, rel=0.01)


def test_missed_targets_are_told(spark):
    rows, labels = [(i, "the same words") for i in range(20)], [(i, i % 2, 0) for i in range(20)]
    with pytest.warns(UserWarning, match="misses its targets"):
        made = mixing(documents(spark, rows), labelled(spark, labels), {"good": 9, "poor": 1})
    assert all(r["rate"] == pytest.approx(1, abs=0.01) for r in made.collect())


@pytest.mark.parametrize("weights", [{"good": 0.6, "poor": 0.3, "toxic": 0.1},
                                     {"good": 0.05, "poor": 0.9, "toxic": 0.05}])
def test_domains_equal_the_dense_least_squares_solution(spark, weights):
    """Nonnegative least squares over all rates at once, by coordinate descent."""
    rows, labels = corpus(120)
    made = mixing(documents(spark, rows), labelled(spark, labels), weights).collect()
    names = sorted(weights)
    n = np.array([r["n_tokens"] for r in made], float)
    a = (n[:, None] * np.array([[r["posterior"][k] for k in names] for r in made])).T
    goal = np.array([weights[k] for k in names]) / sum(weights.values()) * n.sum()
    rate, off = np.ones(len(n)), a.sum(axis=1) - goal
    for _ in range(3000):
        for i in range(len(n)):
            new = max(0.0, rate[i] - a[:, i] @ off / (a[:, i] @ a[:, i]))
            off += (new - rate[i]) * a[:, i]
            rate[i] = new
        if abs(off).max() < 1e-9 * n.sum():
            break
    got = a @ np.array([r["rate"] for r in made]) - goal
    assert abs(got - off).max() <= 0.005 * n.sum()


def test_a_repeated_doc_id_gives_one_example(spark):
    from stillwell.llm.mixing import classified
    rows, labels = corpus(40)
    many = rows + [(1, f"beta words {i}") for i in range(500)]
    known, names = classified(narrow(documents(spark, many)),
                              domains_of(labelled(spark, labels)), 10_000)
    assert names == ["good", "poor", "toxic"] and known.count() == len(many)
