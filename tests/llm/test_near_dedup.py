import random
import re

import numpy as np
import pytest
from data import documents, prose
from stillwell.llm.common import documents as narrow
from stillwell.llm.near_dedup import near_dedup, near_duplicates, node_links, roots_of, spanned
from stillwell.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    own = [(i, sets(t)) for i, t in rows]
    top = list(range(len(own)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            x, y = own[a][1], own[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return [(i, len(s), own[find(n)][0]) for n, (i, s) in enumerate(own)]


def corpus():
    rng, rows = random.Random(2), []
    for family in range(12):
        words = prose(rng, 60 + family * 10).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randint(0, 99))
            rows.append(" ".join(copy))
    rows += [rows[0].upper(), rows[0].replace(" ", "\n"), "", " \t", "one two", "One  TWO", "one",
             "a b c d e", "long " * 3000 + prose(rng, 3000)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[n]) for i, n in enumerate(order)] + [(1000, None)]


def test_components_equal_brute_force(spark):
    rows = corpus()
    made = near_dedup(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in made) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in made)


@pytest.mark.parametrize("limits", [{"task_node": 2}, {"task_shingles": 100, "pivots": 3}])
def test_large_nodes_and_groups_give_the_same(spark, limits):
    rows = corpus()[:40]
    made = near_duplicates(narrow(documents(spark, rows)), **limits).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in made) == brute(rows)


def test_repeated_and_missing_ids(spark):
    text = prose(random.Random(1), 30)
    rows = [(5, text), (5, text), (None, text), (5, "other words altogether"), (9, None)]
    made = near_dedup(documents(spark, rows)).collect()
    same = [r for r in made if r["n_shingles"] == 26]
    assert [r["component_id"] for r in same] == [5, 5, 5] and sum(r["kept"] for r in same) == 1
    assert sum(r["kept"] for r in made) == 3


def test_empty_table(spark):
    assert near_dedup(documents(spark, [])).collect() == []


def test_branching_keeps_near_sets_together():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**32, 64, dtype=np.uint32)
    near = np.repeat(base[None], 30, axis=0)
    for row in near[1:]:
        row[rng.integers(0, 64, 4)] = rng.integers(0, 2**32, 4)
    far = rng.integers(0, 2**32, (300, 64), dtype=np.uint32)
    far[:, :20] = base[:20]  # share some tokens, as a common passage makes them
    own = np.concatenate([near, far])
    found = set()
    for tree in range(12):
        found |= set(node_links(own, np.uint64(tree + 1), small=16))
    top = roots_of(len(own), found)
    assert set(top[:30]) == {0} and len(set(top)) == 301


def test_pivots_span_all_components():
    rng = random.Random(6)
    links = {(rng.randrange(40), rng.randrange(40)) for _ in range(25)}
    whole = roots_of(40, links)
    made = spanned(40, lambda i: np.array([(i, j) in links or (j, i) in links for j in range(40)]))
    assert roots_of(40, made) == whole


def test_shingles_of_segments_equal_those_of_the_whole(monkeypatch):
    from stillwell.llm import shingles
    text = prose(random.Random(8), 500).encode() + b" " + b"x" * 700 + b" end"
    whole = shingle_sets([text, b"", text[:40]])
    monkeypatch.setattr(shingles, "SEGMENT", 128)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets([text, b"", text[:40]])))
    assert len(whole[0]) == len(sets(text.decode()))


def test_thresholds_set_the_trees():
    from stillwell.llm.near_dedup import DEEP, DEEPEST, LOST, Plan
    at85, at80 = Plan(85), Plan(80)
    assert (at85.second, at85.agree, at85.trees) == (176, 38, 13)
    assert (at80.second, at80.agree, at80.trees) == (250, 33, 18)
    for plan in (at85, at80):
        assert plan.loss(DEEP) <= LOST and plan.loss(DEEPEST) <= 0.1
    assert at85.loss(6) < 1.2e-3 and at80.loss(6) < 1.2e-3


def test_pipeline_stage_takes_copies_from_80_percent(spark):
    import corpus_pipeline
    rng, rows = random.Random(9), []
    for family in range(25):
        words = [w + str(i) for i, w in enumerate(prose(rng, 200).split())]
        rows.append((10 * family, " ".join(words)))
        for at in (30, 70, 110, 150):  # 176 of 216 shingles stay: 0.815
            words[at] = "changed"
        rows.append((10 * family + 1, " ".join(words)))
        rows.append((10 * family + 2, " ".join(words[:100])))
    own = [(i, sets(t)) for i, t in rows]
    top = roots_of(len(own), [(a, b) for a in range(len(own)) for b in range(a) if
                              100 * len(own[a][1] & own[b][1]) >= 80 * len(own[a][1] | own[b][1])])
    want = sorted(i for n, (i, _) in enumerate(rows) if top[n] == n)
    made = corpus_pipeline.near_dedup(spark, documents(spark, rows), None).collect()
    assert sorted(r["doc_id"] for r in made) == want and len(want) == 50
