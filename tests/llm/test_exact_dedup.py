import hashlib
from collections import Counter

import pytest
from data import collected, documents
from stillwell.llm.common import documents as narrow
from stillwell.llm.exact_dedup import duplicates, exact_dedup, merged


def brute(rows):
    norm = [(i, "".join(c.lower() if c.isascii() else c for c in t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    return sorted(((i is None, i or 0, max((x for x in groups[t] if x is not None), default=None),
                   len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), key=str)


ROWS = ([(i, "Same Text") for i in range(40)] + [(i, "sAME tEXT") for i in range(40, 60)]
        + [(100, None), (101, ""), (102, "É"), (103, "é"), (104, "long " * 30000),
           (105, "LONG " * 30000), (None, "lonely"), (7, "same text"), (None, "Same text")])


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_every_split_gives_the_same_groups(spark, counters):
    made = duplicates(narrow(documents(spark, ROWS)), counters).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"], r["group_size"],
                   r["digest"].hex()) for r in made), key=str)
    assert got == brute(ROWS)


def test_one_row_of_each_group_is_kept(spark):
    made = collected(exact_dedup(documents(spark, ROWS)), "doc_id")
    kept = Counter(r["text_sha256"] for r in made if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in made})
    assert all(r["doc_id"] == r["keep_id"] for r in made if r["kept"])


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def test_summary_keeps_every_frequent_key():
    stream = ["a"] * 50 + [str(i) for i in range(60)] + ["b"] * 40
    kept = Counter()
    for at in range(0, len(stream), 7):
        kept.update(stream[at:at + 7])
        kept = merged(kept, 3)
    assert {"a", "b"} <= set(kept) and len(kept) <= 3
    assert all(stream.count(k) - len(stream) / 4 <= n <= stream.count(k) for k, n in kept.items())
