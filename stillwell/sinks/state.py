"""Progress as one table of positions that only grow.

A commit is one folder with the positions it raises, visible once its write has finished; an
attempt that never finished is a folder nobody reads. Positions merge by their maximum, so commits
can be read in any order and more than once. Every ``FOLD`` commits the table is folded into a new
base, with marks that name the commits it holds. Readers pass those over, and the next fold removes
them. So a read opens a bounded number of folders, and one that began before a fold still finds them.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillwell import schemas
from stillwell.files import finished, listed, remove, touch
from stillwell.functions import from_iso

LOAD, WATERMARK, CURSOR, CHUNK, ORIGIN = "load", "watermark", "cursor", "chunk", "origin"
NOTE = "note"  # what a commit is about; goes when it is folded
FOLD = 32


def _number(name: str) -> int:
    return int(name[1:].split("-")[0])


def _parts(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """The newest base, and the commits it does not hold."""
    names = sorted(finished(spark, root))
    base = max((n for n in names if n.startswith("b")), key=_number, default=None)
    held = _held(spark, root, base)
    return base, [n for n in names if n.startswith("c") and n not in held]


def _held(spark: SparkSession, root: str, base: str | None) -> set[str]:
    return set() if base is None else set(listed(spark, f"{root}/{base}/_holds"))


def latest_snapshot(spark: SparkSession, root: str) -> int:
    """Number of the last finished commit, 0 before the first."""
    return max((_number(n) for n in finished(spark, root)), default=0)


def _read(spark: SparkSession, root: str, base: str | None, commits: list[str]) -> DataFrame:
    names = commits if base is None else [base, *commits]
    if not names:
        return spark.createDataFrame([], schemas.STATE)
    return spark.read.schema(schemas.STATE).parquet(*[f"{root}/{name}" for name in names])


def _merged(positions: DataFrame) -> DataFrame:
    return positions.groupBy("scope", "kind", "key").agg(F.max("position").alias("position"))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The positions of all finished commits."""
    base, commits = _parts(spark, root)
    return _merged(_read(spark, root, base, commits).where(F.col("kind") != NOTE))


def positions(spark: SparkSession, root: str, *kinds: str) -> dict[tuple[str, str, str], int]:
    """(scope, kind, key) to position of kinds that the driver may hold: marks of loads and
    folder names. Rows merge as they arrive, so nothing is shuffled."""
    base, commits = _parts(spark, root)
    found: dict[tuple[str, str, str], int] = {}
    for row in _read(spark, root, base, commits).where(F.col("kind").isin(*kinds)).collect():
        key = row["scope"], row["kind"], row["key"]
        found[key] = max(row["position"], found.get(key, row["position"]))
    return found


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Positions only grow, so merging twice gives the same table."""
    return _merged(old.select(*schemas.STATE.names).unionByName(new.select(*schemas.STATE.names)))


def commit_state(
    spark: SparkSession, root: str, new: DataFrame, note: str = "", *, snapshot: int | None = None
) -> int:
    """Add ``new`` after the given (or latest) commit; returns the new number."""
    number = (latest_snapshot(spark, root) if snapshot is None else snapshot) + 1
    line = spark.createDataFrame([("", NOTE, note, number)], schemas.STATE).coalesce(1)
    rows = new.select(*schemas.STATE.names).unionByName(line)
    rows.write.parquet(f"{root}/c{number:010d}-{uuid.uuid4().hex[:8]}")
    base, commits = _parts(spark, root)
    if len(commits) >= FOLD:
        _fold(spark, root, base, commits)
    return number


def _fold(spark: SparkSession, root: str, base: str | None, commits: list[str]) -> None:
    """Write a new base, then remove what the last one held, and the bases before that one."""
    number = max([*map(_number, commits), 0 if base is None else _number(base)])
    new = f"b{number:010d}-{uuid.uuid4().hex[:8]}"
    whole = _merged(_read(spark, root, base, commits).where(F.col("kind") != NOTE))
    whole.hint("rebalance").write.parquet(f"{root}/{new}")
    for name in commits:
        touch(spark, f"{root}/{new}/_holds/{name}")
    older = _held(spark, root, base)
    for name in finished(spark, root):
        if name in older or name.startswith("b") and name not in (base, new):
            remove(spark, f"{root}/{name}")


def origin(spark: SparkSession, root: str, marks: dict) -> str:
    """A name for this progress table, given before its first data. ``marks``: its positions.

    Batches carry the name. Should the progress be lost, its successor has another name, so
    no batch of the old one is ever taken for an unfinished attempt.
    """
    names = [key for _, kind, key in marks if kind == ORIGIN]
    if names:
        return min(names)
    name = uuid.uuid4().hex[:12]
    row = spark.createDataFrame([("", ORIGIN, name, 1)], schemas.STATE)
    commit_state(spark, root, row, "origin")
    return name


# --- typed views -----------------------------------------------------------------------
def rows(df: DataFrame, scope: str, kind: str, key: Column, position: Column) -> DataFrame:
    return df.select(
        F.lit(scope).alias("scope"), F.lit(kind).alias("kind"), key.alias("key"),
        position.cast("bigint").alias("position"),
    )


def _of(state: DataFrame, scope: str, kind: str) -> DataFrame:
    return state.where((F.col("scope") == scope) & (F.col("kind") == kind))


def watermarks(state: DataFrame, scope: str) -> DataFrame:
    return _of(state, scope, WATERMARK).select(
        F.col("key").alias("datastream_key"), F.timestamp_micros("position").alias("watermark")
    )


def watermark_rows(marks: DataFrame, scope: str, column: str = "watermark") -> DataFrame:
    set_ = marks.where(F.col(column).isNotNull())
    return rows(set_, scope, WATERMARK, F.col("datastream_key"), F.unix_micros(column))


def cursors(state: DataFrame, scope: str) -> DataFrame:
    return _of(state, scope, CURSOR).select(
        F.col("key").alias("location_id"), F.col("position").alias("cursor")
    )


def cursor_rows(advanced: DataFrame, scope: str) -> DataFrame:
    return rows(advanced, scope, CURSOR, F.col("location_id").cast("string"), F.col("cursor"))


def last_load(state: DataFrame, scope: str) -> float | None:
    found = _of(state, scope, LOAD).agg(F.max("position")).first()[0]
    return None if found is None else found / 1e6


def load_rows(spark: SparkSession, scope: str, load_id: float) -> DataFrame:
    values = [(scope, LOAD, "last", round(load_id * 1e6))]
    return spark.createDataFrame(values, schemas.STATE)


def last_number(state: DataFrame, scope: str) -> int | None:
    """Number of the last stream batch committed under ``scope``."""
    return _of(state, scope, LOAD).agg(F.max("position")).first()[0]


def last_of(marks: dict, scope: str) -> int | None:
    """The same from ``positions``."""
    return marks.get((scope, LOAD, "last"))


def number_rows(spark: SparkSession, scope: str, number: int) -> DataFrame:
    return spark.createDataFrame([(scope, LOAD, "last", number)], schemas.STATE)


def finished_chunks(state: DataFrame, run_key: str) -> DataFrame:
    return _of(state, run_key, CHUNK).select(F.col("key").alias("chunk_key"))


def chunk_rows(chunks: DataFrame, run_key: str) -> DataFrame:
    return rows(chunks, run_key, CHUNK, F.col("chunk_key"), F.lit(1))


# --- progress kept as JSON files by earlier deployments --------------------------------
def _text_or_none(spark: SparkSession, path: str) -> DataFrame:
    """The file as one row, or no row where it does not exist."""
    try:
        return spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def import_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """``{datastream: time}``; a missing or unreadable file counts as empty."""
    parsed = F.from_json("value", "map<string,string>")
    entries = _text_or_none(spark, path).select(F.explode(parsed).alias("datastream_key", "t"))
    marks = entries.select("datastream_key", from_iso(F.col("t")).alias("watermark"))
    return marks.where(F.col("watermark").isNotNull())


def import_last_load(spark: SparkSession, path: str) -> float | None:
    """``{"last_load_id": x}``; missing is None, unreadable is an error."""
    shape = "last_load_id double, _corrupt_record string"
    parsed = F.from_json("value", shape, {"columnNameOfCorruptRecord": "_corrupt_record"})
    row = _text_or_none(spark, path).select(parsed.alias("j")).select("j.*").first()
    if row is None:
        return None
    if row["_corrupt_record"] is not None:
        raise ValueError(f"unreadable progress file {path}")
    return row["last_load_id"]


def import_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``{"completed_chunks": [...]}``; missing or unreadable counts as empty."""
    parsed = F.from_json("value", "completed_chunks array<string>")["completed_chunks"]
    return _text_or_none(spark, path).select(F.explode(parsed).alias("chunk_key")).distinct()

