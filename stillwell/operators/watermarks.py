"""Per-datastream high-watermarks: what is new, what was loaded already, what comes next."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from stillwell.operators.joins import lookup_join, settle_measured
from stillwell.session import settle


def newest_per_datastream(target: DataFrame) -> DataFrame:
    """Latest stored time per datastream."""
    return target.groupBy("datastream_key").agg(F.max("phenomenon_time").alias("watermark"))


def newest_time(target: DataFrame, key: str) -> DataFrame:
    """Latest stored time of one datastream, as one row."""
    return target.where(F.col("datastream_key") == key).agg(
        F.max("phenomenon_time").alias("watermark")
    )


def effective_watermarks(
    keys: DataFrame, stored: DataFrame, newest: Callable[[], DataFrame] | None = None
) -> DataFrame:
    """The stored watermark of each key, else the latest time the target holds for it.

    ``keys`` holds each datastream of the batch once. ``newest`` gives the latest stored time
    per datastream; it is asked only if a key has no stored watermark. Keys with neither are
    left out. The result is settled.
    """
    marked, small, seen = settle_measured(
        keys.join(stored.select("datastream_key", "watermark"), "datastream_key", "left"),
        F.count_if(F.col("watermark").isNull()).alias("missing"),
    )
    known = marked.where(F.col("watermark").isNotNull())
    missing = marked.where(F.col("watermark").isNull()).select("datastream_key")
    if newest is None or not seen["missing"]:
        return known
    held = lookup_join(newest(), missing, "datastream_key", "left_semi", small=small or None)
    return known.unionByName(settle(held.select("datastream_key", "watermark")))


def with_watermark(
    obs: DataFrame, watermarks: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """Observations with the watermark of their datastream; null where there is none."""
    marks = watermarks.select("datastream_key", "watermark")
    return lookup_join(obs, marks, "datastream_key", small=small)


def is_new():
    """Strictly later than the watermark; everything when there is none."""
    return F.col("watermark").isNull() | (F.col("phenomenon_time") > F.col("watermark"))


def past_watermark(
    obs: DataFrame, watermarks: DataFrame, *, small: bool | None = None
) -> DataFrame:
    return with_watermark(obs, watermarks, small=small).where(is_new()).drop("watermark")


def load_results(marked: DataFrame) -> DataFrame:
    """Counts per datastream of a batch that carries its watermarks.

    A datastream whose rows are all skipped reports its old watermark.
    """
    posted_time = F.when(is_new(), F.col("phenomenon_time"))
    return marked.groupBy("datastream_key").agg(
        F.count(F.lit(1)).alias("considered"),
        F.count_if(is_new()).alias("posted"),
        F.count_if(~is_new()).alias("skipped"),
        F.lit(0).cast("bigint").alias("deleted"),
        F.coalesce(F.max(posted_time), F.max("watermark")).alias("new_watermark"),
    )


def raised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge watermarks; a key never moves back."""
    both = old.select("datastream_key", "watermark").unionByName(
        new.select("datastream_key", "watermark")
    )
    return both.groupBy("datastream_key").agg(F.max("watermark").alias("watermark"))
