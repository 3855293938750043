import pytest
from pyspark.sql import functions as F

from stillwell.operators import joins, ordering
from stillwell.session import settle


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, some without a key, the rest spread out."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 17 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    )
    return spark.range(3000).select(F.col("id"), key.alias("key"))


@pytest.fixture
def lookup(spark):
    rows = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 97, 2)]
    return spark.createDataFrame(rows, "key string, mark int")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_join_equals_the_plain_join(skewed, lookup, how, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 3)
    plain = skewed.join(lookup, "key", how)
    assert rows(joins.split_join(skewed, lookup, ["key"], how)) == rows(plain)


def test_a_lookup_beyond_the_limit_is_not_broadcast(skewed, lookup, monkeypatch):
    called = []
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    real = joins.split_join
    monkeypatch.setattr(joins, "split_join", lambda *a: called.append(1) or real(*a))
    assert rows(joins.lookup_join(skewed, lookup, "key")) == rows(
        skewed.join(lookup, "key", "left")
    )
    assert called


def test_wide_rows_count_against_the_limit(spark, monkeypatch):
    wide = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text"))
    assert joins.measure(wide)[1] > 10_000
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 5_000)
    assert not joins.fits_broadcast(wide)


def test_hottest_keys_are_bounded_and_hold_the_hot_one(skewed):
    found = [row["key"] for row in joins.hottest_keys(skewed, ["key"], 3).collect()]
    assert len(found) == 3 and "hot" in found


def test_numbering_by_range_equals_the_window(skewed):
    facts = settle(skewed.withColumn("t", F.col("id") % 50))  # some rows have no key
    def order(df):
        return rows(df.select("id", "key", "position"))
    by_window = ordering.numbered(facts, ["key"], ["t", "id"])
    by_range = ordering.numbered(facts, ["key"], ["t", "id"], group_limit=0)
    assert order(by_window) == order(by_range)


def test_numbering_spreads_a_single_hot_key_over_tasks(spark):
    facts = spark.range(5000).select(F.lit("only").alias("key"), F.lit(1).alias("t"), "id")
    placed = ordering.numbered(facts, ["key"], ["t", "id"], group_limit=100)
    assert placed.where(F.col("position") != F.col("id") + 1).count() == 0
    assert placed.count() == 5000


def test_chunks_and_their_trail(spark):
    facts = spark.range(25).select(
        F.lit("a").alias("datastream_key"), F.timestamp_seconds("id").alias("phenomenon_time"),
        "id",
    )
    chunks = ordering.chunked(facts, ["datastream_key"], ["phenomenon_time", "id"], size=10)
    trail = ordering.chunk_trail(chunks, ["datastream_key"]).orderBy("chunk").collect()
    assert [(r["chunk"], r["posted"]) for r in trail] == [(0, 10), (1, 10), (2, 5)]
    assert trail[-1]["watermark"].second == 24


def test_pages_are_bounded_and_whole(spark):
    facts = spark.range(25).select(F.lit(1).alias("k"), "id")
    pages = ordering.paged(facts, ["k"], ["id"], ["id"], size=10).orderBy("page").collect()
    assert [len(p["readings"]) for p in pages] == [10, 10, 5]
    assert [r["id"] for p in pages for r in p["readings"]] == list(range(25))


def test_numbering_by_range_stores_keys_and_order_only(skewed, monkeypatch):
    stored = []
    real = ordering.settle
    monkeypatch.setattr(ordering, "settle", lambda df: stored.append(df.schema) or real(df))
    facts = skewed.withColumns({"t": F.col("id") % 50, "payload": F.repeat(F.lit("x"), 100)})
    got = ordering.numbered(facts, ["key"], ["t", "id"], group_limit=0)
    want = ordering.numbered(facts, ["key"], ["t", "id"])
    assert rows(got) == rows(want)
    assert stored and not any("payload" in schema.simpleString() for schema in stored)


def test_numbering_by_range_of_rows_the_order_does_not_tell_apart(skewed):
    facts = skewed.withColumn("t", F.col("id") % 7).select("key", "t")
    got = ordering.numbered(facts, ["key"], ["t"], group_limit=0)
    assert rows(got) == rows(ordering.numbered(facts, ["key"], ["t"]))
