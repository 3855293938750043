"""Positions within an ordered run, fixed-size chunks of it, and bounded pages."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillwell.constants import CHUNK_SIZE
from stillwell.operators.joins import lookup_join
from stillwell.session import settle

GROUP_LIMIT = 2_000_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _numbered_by_range(
    df: DataFrame, keys: list[str], order: list[str], position: str
) -> DataFrame:
    # Only keys and order are sorted and stored. Ranges are cut over both together, so one key may
    # span many tasks; adding the counts of the earlier tasks places its rows. As one struct the
    # keys are never null themselves, so rows with a null key find their run.
    own = F.struct(*keys, *order)
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_same"))
    spread = counts.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = settle(spread.select(
        own.alias("_own"), F.struct(*keys).alias("_key"), "_same",
        F.monotonically_increasing_id().alias("_at"))).withColumn("_task", F.shiftright("_at", 33))
    by_task = Window.partitionBy("_key", "_task")
    before = Window.unboundedPreceding, -1
    within = F.coalesce(F.sum("_same").over(by_task.orderBy("_at").rowsBetween(*before)), F.lit(0))
    runs = spread.groupBy("_key", "_task").agg(F.sum("_same").alias("_rows"))
    earlier = Window.partitionBy("_key").orderBy("_task").rowsBetween(*before)
    runs = runs.select("_key", "_task",
                       F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    starts = lookup_join(spread.withColumn("_within", within), runs, ["_key", "_task"], "inner",
                         derived=True).select(
        "_own", "_same", (F.col("_before") + F.col("_within") + 1).alias("_start"))
    placed = df.withColumn("_own", own).join(starts, "_own")
    # Rows that the order does not tell apart follow one another as they come.
    ties = Window.partitionBy("_own").orderBy(F.lit(0))
    one, more = placed.where("_same = 1"), placed.where("_same > 1")
    single = one.withColumn(position, F.col("_start").cast("bigint"))
    tied = more.withColumn(position, (
        F.col("_start") + F.row_number().over(ties) - 1).cast("bigint"))
    return single.unionByName(tied).drop("_own", "_same", "_start")


def numbered(
    df: DataFrame, keys: list[str], order: list[str],
    *, position: str = "position", group_limit: int | None = None,
) -> DataFrame:
    """1-based position of each row in its ordered run; null keys are a run like any other.
    ``order`` should end in a unique column, which makes the order stable."""
    limit = GROUP_LIMIT if group_limit is None else group_limit
    if largest_group(df, keys) <= limit:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(position, F.row_number().over(window).cast("bigint"))
    return _numbered_by_range(df, keys, order, position)


def chunk_of(position: Column, size: int = CHUNK_SIZE) -> Column:
    """0-based chunk number of a 1-based position."""
    return F.floor((position - 1) / F.lit(size)).cast("bigint")


def chunked(
    df: DataFrame, keys: list[str], order: list[str],
    *, size: int = CHUNK_SIZE, group_limit: int | None = None,
) -> DataFrame:
    placed = numbered(df, keys, order, group_limit=group_limit)
    return placed.withColumn("chunk", chunk_of(F.col("position"), size))


def chunk_trail(chunks: DataFrame, keys: list[str], time: str = "phenomenon_time") -> DataFrame:
    """Rows and last time of every chunk; the last chunk's time is the new watermark."""
    return chunks.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("posted"), F.max(time).alias("watermark")
    )


def paged(
    df: DataFrame, keys: list[str], order: list[str], fields: list[str],
    *, size: int = CHUNK_SIZE, into: str = "readings", group_limit: int | None = None,
) -> DataFrame:
    """Group rows into ordered arrays of at most ``size``, numbered by page.

    A group of any length stays whole as a sequence of pages, and no task ever has to hold
    more than one page of it.
    """
    pages = chunked(df, keys, order, size=size, group_limit=group_limit)
    packed = F.array_sort(F.collect_list(F.struct("position", *fields)))
    grouped = pages.groupBy(*keys, F.col("chunk").alias("page")).agg(packed.alias(into))
    return grouped.withColumn(
        into, F.transform(into, lambda item: F.struct(*[item[f].alias(f) for f in fields]))
    )
