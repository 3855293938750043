import random

import public_tokenizers
from data import collected, documents
from stillwell.llm.common import loaded
from stillwell.llm.token_counts import pretokens, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", " ", "\n", "\t", "'s", "é", "É", "1", "!", ".", ",", "foo,", "it's.", "\x1c", "\xa0",
       "<|endoftext|>", "<|STARTOFTEXT|>", "日本", "İ", "Σ", "é"]


def length(text):
    return len(loaded(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 20))) for _ in range(80)]
    rows = list(enumerate(texts + [None, "", "word " * 40000])) + [(5, "again"), (5, "again"),
                                                                  (None, "no id")]
    for head in (0, 3, 1000):
        made = collected(token_counts(documents(spark, rows), PATH, 2048, head), "doc_id")
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"])
                     for r in made)
        assert got == sorted((i is None, i or 0, len((t or "").encode()), length(t))
                             for i, t in rows)
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in made)


def test_empty_table(spark):
    assert token_counts(documents(spark, []), PATH).collect() == []


def test_stops_are_split_only_where_the_library_does():
    library = loaded(PATH)
    for text in ("a. b, c.. ... d!. 'x. é, 5. ,", "It's, don't.", "x.y. <|endoftext|>."):
        pieces = sum(n * len(library.encode(w.decode(), add_special_tokens=False).ids)
                     for w, n in pretokens(text.encode()).items())
        assert pieces == length(text)


def test_long_runs_are_not_broadcast(spark, monkeypatch):
    from stillwell.llm import token_counts as module
    sent = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast",
                        lambda self, value: sent.append(value) or real(self, value))
    monkeypatch.setattr(module, "GATHERED", 5000)
    rng = random.Random(4)
    rows = [(i, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000))) for i in range(40)]
    rows += [(100, "a short text, and a longer one"), (101, "x" * 200 + " short"), (102, rows[0][1])]
    made = collected(token_counts(documents(spark, rows), PATH), "doc_id")
    assert [(r["doc_id"], r["n_tokens"]) for r in made] == [(i, length(t)) for i, t in rows]
    held = [v for v in sent if isinstance(v, dict)]
    assert held and all(len(word) <= module.LONGEST for words in held for word in words)
