"""Incremental scans of the raw zone by load id.

A load id is the leading decimal of a file name (``1781192390.555875.0.parquet``) or a
``load_id=`` folder. Both are read from ``_metadata.file_path``; a predicate on that column
prunes files while Spark lists them, so files of old loads are never opened.
"""

import re
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stillwell.files import entries, exists, holds_file, listed
from stillwell.operators.grouping import last_per_key

LOAD_FOLDER = r"^[^/]*/load_id=(\d+\.\d+)/"
LOAD_NAME = r"^[^/]*/(\d+\.\d+)\."


def load_folder(root: str, load_id: float) -> str:
    """Date folders of the load's own time, then the load: never of event time."""
    when = datetime.fromtimestamp(load_id, timezone.utc)
    return f"{root}/year={when:%Y}/month={when:%m}/day={when:%d}/load_id={load_id:.6f}"


def load_id_of(path: Column) -> Column:
    """Load id of a file path; null where the name has none.

    Scans evaluate this for every row, so only the end of the path is searched, from its start,
    and no part of it twice; text that does not match is empty, which is no number.
    """
    folder = F.regexp_extract(F.substring_index(path, "/", -3), LOAD_FOLDER, 1)
    name = F.regexp_extract(F.substring_index(path, "/", -2), LOAD_NAME, 1)
    return F.coalesce(folder.try_cast("double"), name.try_cast("double"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under ``path``, or no rows where nothing was written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def paths_since(spark: SparkSession, root: str, since: float | None) -> list[str]:
    """The load folders and files under ``root`` that are newer than ``since``.

    Load folders this package wrote are told by their name and not listed any further, so
    old loads cost one name each. Files of any other layout are picked by their own load id,
    in whatever folder they lie.
    """
    return sorted(path for path, load_id in named_loads(spark, root)
                  if since is None or load_id > since)


def named_loads(spark: SparkSession, root: str) -> list[tuple[str, float]]:
    """Every load folder, and every data file outside of one, with its load id, by name alone."""
    found, open_ = [], [root]
    while open_:
        for path, is_folder in entries(spark, open_.pop()):
            name = path.rsplit("/", 1)[1]
            if is_folder:
                if own := re.fullmatch(r"load_id=(\d+\.\d+)", name):
                    found.append((path, float(own[1])))
                elif not name.startswith(("_", ".")):
                    open_.append(path)
            elif own := re.match(r"(\d+\.\d+)\..*parquet$", name):
                found.append((path, float(own[1])))
    return found


def newest_of(spark: SparkSession, paths: list[str], since: float | None) -> float | None:
    """Highest load id among ``paths`` that holds a data file, never below ``since``. A folder
    without one is a load that is still being written."""
    def key(path):
        return float(re.search(r"(?:load_id=|/)(\d+\.\d+)[^/]*$", path)[1])

    for path in sorted(paths, key=key, reverse=True):
        if "/load_id=" not in path or any(n.endswith(".parquet") for n in listed(spark, path)):
            return key(path)
    return since


def list_loads(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Every data file with its load id; contents are not read."""
    if not root or isinstance(root, str) and not exists(spark, root):
        return spark.createDataFrame([], "path string, load_id double")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, load_id double")
    parquet = files.select("path").where(F.col("path").endswith(".parquet"))
    return parquet.select("path", load_id_of(F.col("path")).alias("load_id"))


def newest_load(spark: SparkSession, root: str | list[str], since: float | None = None) -> float | None:
    """Highest load id over files (not rows), never below ``since``."""
    newest = list_loads(spark, root).agg(F.max("load_id")).first()[0]
    known = [value for value in (newest, since) if value is not None]
    return max(known) if known else None


def _scan(spark: SparkSession, root, schema: T.StructType, chosen: Column) -> DataFrame:
    paths = [root] if isinstance(root, str) else root
    files = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
    return files.where(chosen).select(
        *schema.names,
        load_id_of(F.col("_metadata.file_path")).alias("load_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _empty_scan(spark: SparkSession, schema: T.StructType) -> DataFrame:
    extra = [T.StructField("load_id", T.DoubleType()), T.StructField("file", T.StringType()),
             T.StructField("row", T.LongType())]
    return spark.createDataFrame([], T.StructType(schema.fields + extra))


def _guarded(spark, root, schema, chosen) -> DataFrame:
    if not root or isinstance(root, str) and not exists(spark, root):
        return _empty_scan(spark, schema)
    try:
        return _scan(spark, root, schema, chosen)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty_scan(spark, schema)


def scan_new(
    spark: SparkSession, root: str | list[str], schema: T.StructType,
    since: float | None = None, until: float | None = None,
) -> DataFrame:
    """Rows of files newer than ``since`` (all named files when None), up to ``until``.

    ``until`` pins the scan to the files seen when the run started. ``file`` and ``row``
    give the arrival order.
    """
    load_id = load_id_of(F.col("_metadata.file_path"))
    bounds = []  # a file without a load id meets none of them
    if since is not None:
        bounds.append(load_id > F.lit(float(since)))
    if until is not None:
        bounds.append(load_id <= F.lit(float(until)))
    chosen = reduce(Column.__and__, bounds) if bounds else load_id.isNotNull()
    return _guarded(spark, root, schema, chosen)


def scan_load(spark: SparkSession, root: str, schema: T.StructType, load_id: float) -> DataFrame:
    """Rows of exactly one load. Its own folder is read alone; where there is none, its files are
    found by name wherever under ``root`` they lie."""
    folder = load_folder(root, load_id)
    if exists(spark, folder):
        return scan_written(spark, folder, schema)
    named = [path for path, own in named_loads(spark, root) if own == float(load_id)]
    return _guarded(spark, named, schema, F.lit(True))


def scan_written(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of a load this package has just written to ``folder``; nothing else is listed."""
    return _guarded(spark, folder, schema, F.lit(True))


def scan_stations(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The station table, last row per id in file and row order. Missing files are an error."""
    if not holds_file(spark, root, ".parquet"):
        raise FileNotFoundError(f"no station files under {root}; run the ingest first")
    files = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    rows = files.select(
        *schema.names,
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    return last_per_key(rows, ["id"], ["file", "row"]).select(*schema.names)
