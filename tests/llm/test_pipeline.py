"""The pipeline's stages over the smallest tables, each against a plain computation."""

import pathlib
from collections import Counter

import pytest
from data import DOCUMENTS, CLASHING
from test_near_dedup import brute as near_groups
from test_packing import PATH

import corpus_pipeline
from stillwell.llm.common import loaded
from stillwell.llm.toxicity import toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(out / name))
        docs = spark.read.parquet(str(out / name))
        made.append(docs)
    return made


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_stay(stages):
    assert all(set(s.columns) == set(stages[0].columns) for s in stages[:-1])


def test_toxic_documents_go(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in
              spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = (dict(rows(s)) for s in stages[:2])
    gone = set(before) - set(after)
    kept = toxicity(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert gone == {r["doc_id"] for r in kept.filter("predicted = 1").collect()}
    assert not [i for i in gone if labels.get(i) == 0]


def test_one_of_each_text_stays(stages):
    groups = {}
    for i, text in rows(stages[1]):
        groups.setdefault("".join(c.lower() if c.isascii() else c for c in text), []).append(i)
    assert [r[0] for r in rows(stages[2])] == sorted(max(g) for g in groups.values())


def test_one_of_each_near_group_stays(stages):
    want = sorted({g for _, _, g in near_groups(
        rows(stages[2]), corpus_pipeline.SIMILAR)})
    assert [r[0] for r in rows(stages[3])] == want


def test_mixing_keeps_every_document(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after) and len(after) < 3 * len(before)


def test_every_token_is_packed(stages):
    library, packed = loaded(PATH), Counter()
    for r in stages[5].collect():
        packed[r["doc_id"]] += r["length"]
    want = Counter()
    for i, text in rows(stages[4]):
        want[i] += len(library.encode(text, add_special_tokens=False).ids) + 1
    assert packed == want


def test_run_gives_the_same(spark, stages):
    def key(df):
        return sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length",
                                                  "ids_crc32").collect())
    assert key(corpus_pipeline.run(spark, FOLDER)) == key(stages[5])


def test_awkward_rows_pass(spark, tmp_path):
    table = [(1, "some words here", "en"), (1, "some words here", None), (1, "others", None),
             (None, None, None), (None, "Some words HERE", "de"), (3, "", "en"), (4, "x" * 50000, "en")]
    frame = spark.createDataFrame(
        [(i, t, lang, None, None, 7, None, "x", 0.5, 9, 3) for i, t, lang in table],
        DOCUMENTS + CLASHING)
    for source, own in ((frame, table), (frame.limit(0), [])):
        folder = pathlib.Path(tmp_path) / str(len(own))
        spark.read.parquet(f"{FOLDER}/labels.parquet").limit(0).write.parquet(
            str(folder / "labels.parquet"))
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(folder)).write.parquet(str(folder / name))
            docs = spark.read.parquet(str(folder / name))
            if name == "exact_dedup":
                got = Counter(r["text"] or "" for r in docs.collect())
                assert got == (Counter({"some words here": 1, "others": 1, "": 1, "x" * 50000: 1})
                               if own else Counter())
            if name != "packing":
                assert docs.columns == frame.columns
        assert (docs.count() > 0) == bool(own)
