import hashlib
import random
import zlib

import pytest
from data import documents
from stillwell.llm import merkle
from stillwell.llm.merkle import (
    appended, folded, forest, height, manifest, node, place, siblings, tamper_check)


def text_digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, change=False):
    values = list(row)
    if change and values[4] is not None:
        values[4] = values[4].replace("\n", "")
    return text_digest("".join(
        "-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([text_digest("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(levels, i):
    """(left, right) siblings of leaf ``i``, level by level."""
    out = []
    for level in levels[:-1]:
        first = i - i % 3
        out.append((level[first:i], level[i + 1:first + 3]))
        i //= 3
    return out


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: b"" if s is None else b"+" + s.encode())
    own = {s: sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
           for s in order}
    low = {s: levels_of([leaf_of(r) for r in own[s]]) for s in order}
    high = levels_of([low[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, row in enumerate(own[s]):
            path = way(low[s], i) + way(high, at)
            now = leaf_of(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0)
            for left, right in path:
                now = text_digest("".join([*left, now, *right]))
            out.append((row[0], leaf_of(row), low[s][-1][0], high[-1][0],
                        text_digest("".join(d for a, b in path for d in a + b)), now,
                        now == high[-1][0]))
    return sorted(out, key=repr)


def rows_of(rng, n, sources):
    texts = ["", None, "one line", "two\nlines", "\n", "é日\n𝔸", "x" * 3000 + "\n"]
    return [(rng.choice([i, i, i, i // 2]), rng.choice(sources), rng.choice(["en", None, ""]),
             rng.choice([None, 0, 12]), rng.choice(texts)) for i in range(n)]


def check(spark, rows):
    table = spark.createDataFrame(
        [(*r, 1, "x", b"y", 2, 3) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, "
        "index long, tree string, digest binary, n long, block long")
    made = sorted((tuple(r) for r in tamper_check(table).collect()), key=repr)
    assert made == brute(rows)


def test_whole_manifest(spark):
    rng = random.Random(1)
    rows = rows_of(rng, 70, ["a", "a", "a", "b", "é", "", None, "zz"])
    check(spark, rows + [(None, None, None, None, None), (None, "a", "en", 1, "\n"), rows[0], rows[0]])


@pytest.mark.parametrize("sources", [["only"], list("abcdefghijklmnopqrst"), [None]])
def test_many_rounds(spark, monkeypatch, sources):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    check(spark, rows_of(random.Random(len(sources)), 59, sources))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10])
def test_small_tables(spark, n):
    check(spark, rows_of(random.Random(n), n, ["a", None]))


def test_empty_table(spark):
    assert tamper_check(documents(spark, [])).collect() == []


def test_log_is_in_order_of_completion():
    for n in range(1, 100):
        leaves = [bytes([i]) * 32 for i in range(n)]
        for levels in (height(n), height(n) + 2):
            log = appended(leaves, levels)
            at = leaves
            for level in range(levels + 1):
                assert [log[place(level, i, n, levels)] for i in range(len(at))] == at
                at = [node(at[i:i + 3]) for i in range(0, len(at), 3)]
            assert len(log) == sum(-(-n // 3 ** j) for j in range(levels + 1))
            steps = siblings(b"".join(log), n, levels)
            for i in range(n):
                path = b"".join(s[i // 3 ** j] for j, s in enumerate(steps))
                assert folded(leaves[i], path) == log[-1]


def test_rows_of_blocks_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = spark.range(200).selectExpr("'t' AS tree", "id AS place", "struct(id) AS row",
                                       "unhex(sha2(string(id), 256)) AS digest")
    rounds, roots = forest(rows, ["place"])
    assert [r.count() for r in rounds] == [23, 3, 1]
    assert max(len(r["rows"]) for r in rounds[0].collect()) == 9
    want = levels_of([text_digest(str(i)) for i in range(200)])[-1][0]
    assert roots.first()["root"].hex() == want


def test_carried_rows_come_back_with_their_path(spark):
    rows = spark.range(40).selectExpr(
        "IF(id % 3 = 0, NULL, string(id % 3)) AS s", "id AS place", "struct(id, 'x' AS more) AS row",
        "unhex(sha2(string(id), 256)) AS digest")
    proofs, root = manifest(rows, "s", ["place"])
    got = proofs.collect()
    assert sorted(r["row"]["id"] for r in got) == list(range(40))
    for r in got:
        assert r["leaf"].hex() == text_digest(str(r["row"]["id"]))
        assert folded(r["leaf"], r["path"]) == root
