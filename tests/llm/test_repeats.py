import hashlib
import random

import numpy as np
from data import documents, prose
from stillwell.llm import repeats
from stillwell.llm.bwt import Collection
from stillwell.llm.common import documents as narrow, ROW
from stillwell.llm.repeats import repeated_spans, suffix_dedup, without


def brute(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, digest), rows in the order of documents."""
    seen, out = {}, []
    for i, text in rows:
        text = (text or "").encode()
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - length + 1):
            if text[at:at + length] in seen:
                gone[at:at + length] = True
            seen[text[at:at + length]] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        starts = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
        out.append((i, len(text), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(9)
    passages = [prose(rng, 40) for _ in range(4)] + [" " * 150, "ab" * 120]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 30)) for _ in range(3)]
        if i % 2:
            parts.insert(1, rng.choice(passages))
        if i % 5 == 0:
            parts.append(passages[0][rng.randint(0, 30):])
        rows.append((i, " ".join(parts)))
    rows += [(60, rows[3][1]), (61, None), (62, ""), (63, "x" * 99), (64, "y" * 300),
             (65, passages[1]), (66, prose(rng, 3000) + passages[2])]
    return rows


def test_removal_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(repeats, "SEGMENT", 1 << 12)  # the long text spans several segments
    made = suffix_dedup(documents(spark, rows).repartition(3))
    assert sorted(tuple(r)[:5] for r in made.collect()) == brute(rows)


def test_hot_anchors_are_cut_into_single_strings(spark):
    rows = corpus()
    docs = narrow(documents(spark, rows))
    for hot in (1, 3):
        spans = {}
        for r in repeated_spans(docs, hot=hot).collect():
            spans.setdefault(r[ROW], []).append((r["start"], r["end"]))
        got = [(i, *without((t or "").encode(), spans.get(i, []))[1:]) for i, t in rows]
        assert got == [(r[0], r[2], r[3]) for r in brute(rows)]


def test_repeated_and_missing_ids(spark):
    text = prose(random.Random(1), 60)
    rows = [(3, text), (3, text), (None, text), (1, text + " end")]
    made = {(r["doc_id"], r["n_removed"]) for r in suffix_dedup(documents(spark, rows)).collect()}
    n = len(text)
    assert (1, 0) in made and (3, n) in made and (None, n) in made


def test_empty_table(spark):
    assert suffix_dedup(documents(spark, [])).collect() == []


def test_collection_gives_the_suffix_order(tmp_path):
    rng = random.Random(4)
    base = bytes(rng.choice(b"abc") for _ in range(30))
    strings = [base[rng.randint(0, 10):] + bytes(rng.choice(b"abc") for _ in range(8))
               for _ in range(25)]
    prefix, string, at = Collection(strings, 12, str(tmp_path)).build()
    assert list(tmp_path.iterdir()) == []
    suffixes = [strings[s][a:] for s, a in zip(string, at)]
    assert suffixes == sorted(suffixes)
    assert len(suffixes) == sum(len(s) + 1 for s in strings)
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert prefix[i] == min(n, 12)


def test_cutting_spans():
    assert without(b"abcdefgh", [(1, 3), (2, 4), (6, 7)]) == (b"aefh", 4, 2)
    assert without(b"abc", []) == (b"abc", 0, 0)
