"""Helpers shared by the operators: row keys, stored intermediates, Arrow maps, set filters."""

import contextlib
import ctypes
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import stillwell.llm
from stillwell.session import durable_dir

# Functions of this package travel inside the tasks, so executors need not have it installed.
cloudpickle.register_pickle_by_value(stillwell.llm)

ROW = "_row"
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back.

    Cuts the lineage like a checkpoint, but keeps columns apart, so later reads take only what
    they need. A retried task replaces its own file.
    """
    spark = df.sparkSession
    path = f"{durable_dir(spark).rstrip('/')}/stillwell-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keyed(docs: DataFrame, key: str = ROW) -> DataFrame:
    """Add a unique long ``key`` whose order is that of doc_id.

    With unique doc_ids without nulls it is the doc_id itself. Otherwise rows are range-sorted by
    doc_id (nulls last) and a hash of the text, and their place is stored.
    """
    n = docs.agg(
        F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("ids"),
        F.count_distinct("doc_id").alias("distinct"),
    ).first()
    if n["rows"] == n["ids"] == n["distinct"]:
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.withColumn(key, F.monotonically_increasing_id()), "rows")


def documents(docs: DataFrame) -> DataFrame:
    """The columns operators work on: row key, doc_id, text (null counts as empty)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return keyed(narrow).select(ROW, "doc_id", "text")


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[dict]], Iterable[dict]], schema: str,
    *, rows: int = BATCH_ROWS,
) -> DataFrame:
    """``mapInArrow`` over batches of at most ``rows`` rows and about ``BATCH_BYTES``, with columns
    as a dict of Arrow arrays, and results as dicts of lists or arrays."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    wanted = _arrow_schema(df.sparkSession, schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (dict(zip(names, b.columns)) for b in batches if b.num_rows)
        try:
            for made in function(columns):
                arrays = [
                    made[f.name].cast(f.type) if isinstance(made[f.name], pa.Array)
                    else pa.array(made[f.name], type=f.type) for f in wanted
                ]
                if len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, schema=wanted)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


class Shared:
    """A broadcast value of any class of this package; its code travels with it."""

    def __init__(self, spark: SparkSession, value):
        self.packed, self.own = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"packed": self.packed, "own": None}

    @property
    def value(self):
        if self.own is None:
            self.own = cloudpickle.loads(self.packed.value)
        return self.own


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bloom:
    """A Bloom filter over 64-bit keys; ``words`` are its bits."""

    def __init__(self, words: np.ndarray, hashes: int, salt: int):
        self.words, self.hashes, self.salt = words, hashes, salt

    @staticmethod
    def places(keys: np.ndarray, bits: int, hashes: int, salt: int) -> np.ndarray:
        """(hashes, n) bit numbers of the keys; ``bits`` is a power of two."""
        with np.errstate(over="ignore"):
            one = mixed(keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64))
            two = mixed(one) | np.uint64(1)
            steps = np.arange(hashes, dtype=np.uint64)[:, None]
            return ((one + steps * two) >> np.uint64(7)) & np.uint64(bits - 1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        at = self.places(keys, len(self.words) * 64, self.hashes, self.salt)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def bloom_of(keys: DataFrame, column: str, bits: int, hashes: int, salt: int = 0) -> Bloom:
    """Build the filter on the executors: tasks set bits, words meet by ``bit_or``; the driver
    gets ``bits`` / 8 bytes at most, whatever the number of keys."""
    def words(batches):
        for b in batches:
            at = Bloom.places(b[column].to_numpy(zero_copy_only=False), bits, hashes, salt).ravel()
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(word, kind="stable")
            word, bit = word[order], bit[order]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            yield {"word": word[first], "bits": np.bitwise_or.reduceat(bit, first).view(np.int64)}

    made = (map_arrow(keys.select(column), words, "word long, bits long", rows=8192)
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    if made.num_rows:
        out[made["word"].to_numpy()] = made["bits"].to_numpy().view(np.uint64)
    return Bloom(out, hashes, salt)


def likely(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test of a long column against ``keys``: true for all of them, and for few others as long as
    the filter is not full. It spares rows that are surely not meant the shuffle of a join."""
    found = bloom_of(keys, column, power_of_two(16 * keys.count()), 5)
    known = Shared(keys.sparkSession, found)

    @F.pandas_udf("boolean")
    def hit(values: pd.Series) -> pd.Series:
        return pd.Series(known.value.holds(values.to_numpy()))

    return hit


#: The largest filter: 64 MB in a task, and some 130 MB on the way to the driver. Up to 33 M keys it
#: has 16 bits a key. Beyond, more rows pass it by chance (with 4 bits a key a third), at worst all
#: rows once, which the exact step behind it sorts out.
MOST_BITS = 2**29


def power_of_two(n: float, least: int = 64, most: int = MOST_BITS) -> int:
    size = least
    while size < n and size < most:
        size *= 2
    return size


def loaded(path: str):
    """The tokenizer of a file, without truncation and padding, on the task's own thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library
