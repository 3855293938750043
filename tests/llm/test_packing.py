import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from data import documents, prose
from stillwell.llm.common import loaded
from stillwell.llm.packing import Ids, Places, best_fit_packing, bins, fullest

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "1", "!", "\xa0", "\x1c", "\x00",
       "<|endoftext|>", "日本", " \n", "\r\n", "x", "　"]


def first_fit(lengths, limit):
    """Sequences that first-fit decreasing needs."""
    room = []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(limit)
        room[at] -= n
    return len(room)


def test_ids_equal_the_library():
    rng, library = random.Random(5), loaded(PATH)
    for own in (Ids(PATH), Ids(PATH, RANKS)):
        for _ in range(2000):
            text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 12)))
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.of(text), "<u4").tolist() == want, repr(text)


def test_ranks_equal_the_library_on_every_letter():
    library, own = loaded(PATH), Ids(PATH, RANKS)
    texts = [f"a{chr(c)}1{chr(c)}! {chr(c)}b" for c in range(0x20000)
             if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    made = library.encode_batch_fast(texts, add_special_tokens=False)
    assert all(np.frombuffer(own.of(t), "<u4").tolist() == e.ids for t, e in zip(texts, made))


def test_every_piece_has_its_place(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randint(0, 900))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "word " * 9000), (3, "again"), (3, "again"),
             (None, "no id")]
    made = best_fit_packing(documents(spark, rows).repartition(3), PATH).collect()
    library = loaded(PATH)
    want = Counter()
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        start, end = 0, (len(ids) - 1) % 2048 + 1
        while start < len(ids):
            want[i, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
            start, end = end, end + 2048
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in made) == want
    sequences = defaultdict(list)
    for r in made:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= first_fit([r["length"] for r in made], 2048)


def test_empty_table(spark):
    assert best_fit_packing(documents(spark, []), PATH).collect() == []


def test_fullest_is_the_best_subset():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        capacity = rng.randint(1, 60)
        sums = {0}
        for length, n in counts.items():
            sums |= {s + k * length for s in sums for k in range(n + 1)}
        chosen = fullest(capacity, sorted(counts, reverse=True), counts)
        assert sum(chosen) == max(s for s in sums if s <= capacity)
        assert all(k <= counts[n] for n, k in Counter(chosen).items())


def test_bins_use_every_piece_once():
    rng = random.Random(2)
    counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, 101), 40)}
    kinds = bins(counts, 100)
    used = Counter()
    for times, held in kinds:
        assert sum(held) <= 100
        for n in held:
            used[n] += times
    assert used == counts
    lengths = [n for n, c in counts.items() for _ in range(c)]
    assert sum(t for t, _ in kinds) <= first_fit(lengths, 100)
    places, seen = Places(kinds), set()
    for n, c in counts.items():
        seen |= {(s, o) for s, o in zip(*places.find(np.full(c, n), np.arange(c)))}
    assert len(seen) == sum(counts.values())
