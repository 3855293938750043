"""Folder names in any store Spark can reach; contents are not read."""

import re

from pyspark.sql import SparkSession

_PLAIN = re.compile(r"[\w. ,+@~-]+")


def _store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return store.exists(at)


def listed(spark: SparkSession, root: str) -> list[str]:
    """Names of what lies in a folder; none where it does not exist."""
    store, at = _store(spark, root)
    return [e.getPath().getName() for e in store.listStatus(at)] if store.exists(at) else []


def entries(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """(path, whether it is a folder) of what lies in a folder; none where it does not exist."""
    store, at = _store(spark, root)
    if not store.exists(at):
        return []
    return [(e.getPath().toString(), e.isDirectory()) for e in store.listStatus(at)]


def holds_file(spark: SparkSession, root: str, suffix: str) -> bool:
    """Whether a file with that ending lies anywhere in a folder; stops at the first one."""
    waiting = [root]
    while waiting:
        for path, is_folder in entries(spark, waiting.pop()):
            if is_folder:
                waiting.append(path)
            elif path.endswith(suffix):
                return True
    return False


def finished(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root`` that a Spark write has finished."""
    store, at = _store(spark, f"{root}/*/_SUCCESS")
    return [e.getPath().getParent().getName() for e in store.globStatus(at) or []]


def holding(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern`` (escaped values, ``*`` for the rest)."""
    store, at = _store(spark, pattern)
    return [e.getPath().toString() for e in store.globStatus(at) or []]


def touch(spark: SparkSession, path: str) -> None:
    store, at = _store(spark, path)
    store.create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    store, at = _store(spark, path)
    store.delete(at, True)


def escaped(spark: SparkSession, value: str) -> str:
    """``value`` as Spark writes it into the name of a partition folder."""
    if _PLAIN.fullmatch(value):
        return value
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def unescaped(spark: SparkSession, value: str) -> str:
    if "%" not in value:
        return value
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
        value)
