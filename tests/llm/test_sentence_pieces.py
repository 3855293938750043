import hashlib
import random

import pytest
import public_tokenizers
import sentencepiece
from data import collected, documents
from stillwell.llm.common import Shared
from stillwell.llm.piece_table import Encoder, PieceTable, merged
from stillwell.llm.sentence_pieces import decoded, encode_and_decode, encoded

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = [" ", "  ", "     ", "a", "b", "the", "er", "in", "\n", "\t", "é", "日本", "▁", "\x00", "1",
       "𝔸", "İ", "<s>", "</s>", "<0x0A>", "<unk>", "�", "́", "==", "https://", "한"]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_row_equals_the_library(spark):
    texts = odd_texts(150) + [None, "", " ", " " * 37, "ab" * 60000, "word " * 40000, "日" * 5000]
    rows = list(enumerate(texts)) + [(5, "again"), (5, "again"), (None, "no id"), (None, None)]
    made = encode_and_decode(documents(spark, rows), PATH).collect()
    want = []
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids))))
    assert sorted(map(repr, map(tuple, made))) == sorted(map(repr, want))


def test_tokens_by_last_of_prefix_equal_merging():
    table = PieceTable(PATH)
    encoder = Encoder(table)
    rank = {p: -LIBRARY.get_score(i) for p, i in table.pieces.items() if len(p) > 1}
    for text in odd_texts(300, 5):
        symbols, _ = merged(list("▁" + text.replace(" ", "▁")) if text else [], rank)
        ids = []
        for s in symbols:
            ids += [table.pieces[s]] if s in table.pieces else [table.bytes[b] for b in s.encode()]
        assert memoryview(encoder.ids(text)).cast("i").tolist() == ids


def test_pairs_fit_as_the_library_encodes_them():
    table, rng = PieceTable(PATH), random.Random(7)
    pieces = [p for p in table.pieces if not p.startswith("▁") and len(p) < 6]
    short = [p for p in pieces if p.isascii()]
    for _ in range(3000):
        a, b = rng.choice(short), rng.choice(short)
        symbols, _ = merged(list(a + b), {p: table.ranks[i] for p, i in (
            (p, table.pieces.get(p)) for p in substrings(a + b)) if i is not None})
        assert table.together(table.pieces[a], table.pieces[b]) == (symbols == [a, b])


def substrings(text):
    return {text[i:j] for i in range(len(text)) for j in range(i + 2, len(text) + 1)}


def test_spaces_merge_from_the_left_among_equals():
    encoder = Encoder(PieceTable(PATH))
    for n in range(1, 70):
        for text in (" " * n, " " * n + "a", "a" + " " * n):
            assert memoryview(encoder.ids(text)).cast("i").tolist() == LIBRARY.encode(text)


def test_small_memories_change_nothing(monkeypatch):
    from stillwell.llm import piece_table
    table = PieceTable(PATH)
    monkeypatch.setattr(piece_table, "KNOWN_WORDS", 2)
    monkeypatch.setattr(piece_table, "KNOWN_PAIRS", 3)
    encoder = Encoder(table)
    for text in odd_texts(100, 9):
        assert memoryview(encoder.ids(text)).cast("i").tolist() == LIBRARY.encode(text)


def test_decoding_any_ids(spark):
    rng = random.Random(11)
    some = [0, 1, 2, 3, 35, 196, 259, 260, 28705, 29473] + list(range(100, 259, 13))
    lists = [[rng.choice(some) for _ in range(rng.randint(0, 9))] for _ in range(200)]
    rows = [(n, ids) for n, ids in enumerate(lists)] + [(900, None), (None, [])]
    made = decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    assert sorted((repr(r["doc_id"]), r["text"]) for r in made) == sorted(
        (repr(i), LIBRARY.decode(ids or [])) for i, ids in rows)


def test_unknown_ids_are_refused(spark):
    rows = spark.createDataFrame([(1, [40000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        decoded(rows, PATH).collect()


def test_texts_come_back(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(60)) if "▁" not in t]
    made = collected(decoded(encoded(documents(spark, rows), PATH), PATH), "doc_id")
    assert [(r["doc_id"], r["text"]) for r in made] == rows


def test_empty_table(spark):
    assert encode_and_decode(documents(spark, []), PATH).collect() == []


def test_the_table_can_be_sent(spark):
    assert Shared(spark, PieceTable(PATH)).value.end == 2
