import random
import zlib

import numpy as np
from data import documents, prose
from stillwell.llm.toxicity import BlockMaxIndex, toxicity, words

BAD = ["vile", "scum", "rotten", "awful"]


def corpus(n=400):
    rng, rows, labels = random.Random(3), [], []
    for i in range(n):
        text = prose(rng, rng.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            parts = text.split()
            for _ in range(rng.randint(2, 4)):
                parts.insert(rng.randrange(len(parts)), rng.choice(BAD) + rng.choice(["", ",", "!"]))
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_judged_right(spark):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (1002, "scum"), (7, rows[7][1]), (None, "vile scum"),
             (1003, "fine " * 50000)]
    labels += [(1, None, None), (None, 1, 1), (2, 1, 0)]
    made = toxicity(documents(spark, rows), labelled(spark, labels)).collect()
    assert len(made) == len(rows)
    truth = {i: t for i, _, t in labels if t is not None}
    held = [r for r in made if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
               for r in made if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    by_id = {r["doc_id"]: r for r in made}
    assert by_id[1000]["predicted"] == by_id[1001]["predicted"] == by_id[1003]["predicted"] == 0
    assert by_id[1000]["score"] == by_id[1001]["score"]
    assert by_id[1002]["predicted"] == by_id[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in made)


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t)
               for i, q, t in labels]
    one, two = ({r["doc_id"]: r["score"] for r in toxicity(
        documents(spark, rows), labelled(spark, own)).collect()} for own in (labels, flipped))
    assert one == two


def test_no_labels_and_no_rows(spark):
    rows, labels = corpus(20)
    made = toxicity(documents(spark, rows), labelled(spark, [])).collect()
    assert {r["score"] for r in made} == {0.1}
    assert toxicity(documents(spark, []), labelled(spark, labels)).collect() == []


def test_block_max_search_is_exact():
    rng = random.Random(4)
    examples = []
    for i in range(500):
        terms = sorted(rng.sample(range(60), rng.randint(1, 8)))
        examples.append((i, i % 2, terms, [rng.randint(1, 4) for _ in terms]))
    idf = np.array([1 + rng.random() * 3 for _ in range(60)])
    index = BlockMaxIndex(examples, idf, block=16)
    opened = 0
    for query in examples[:60]:
        dense = np.zeros((len(index.ids), 60))
        for row, i in enumerate(index.ids):
            dense[row, examples[i][2]] = index.weights(*examples[i][2:])
        q = np.zeros(60)
        q[query[2]] = index.weights(*query[2:])
        cosine = np.round(dense @ q, 12)
        want = [index.ids[j] for j in np.argsort(-cosine, kind="stable") if cosine[j] > 0][:10]
        at, scores, blocks = index.nearest(query[2], query[3], 10)
        opened += blocks
        assert index.ids[at].tolist() == want
    assert opened < 60 * index.blocks


def test_words():
    assert words("Don't, STOP!\nÉté") == [b"don", b"t", b"stop", "été".encode()]
