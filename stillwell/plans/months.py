"""Calendar-month plans over a half-open date range, and which chunk a row belongs to."""

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillwell.functions import chunk_key, iso_text
from stillwell.operators.filters import in_window


def midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def month_plan(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``chunk_start, chunk_end`` per calendar month; first and last clipped."""
    if start >= end:
        raise ValueError(f"start ({start}) must be before end ({end})")
    bounds = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return month_plans(bounds, "s", "e").select("chunk_start", "chunk_end")


def month_plans(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """The month plan of every row's own range; rows with an empty range give none."""
    first = F.trunc(F.col(start).cast("date"), "month")
    last = F.date_sub(F.col(end).cast("date"), 1)
    month = F.sequence(first, last, F.expr("interval 1 month"))
    filled = ranges.where(F.col(start).cast("date") < F.col(end).cast("date"))
    months = filled.withColumn("_m", F.explode(month))
    begin = F.greatest(F.col("_m"), F.col(start).cast("date"))
    stop = F.least(F.add_months("_m", 1), F.col(end).cast("date"))
    return months.withColumns({
        "chunk_start": begin.cast("timestamp"), "chunk_end": stop.cast("timestamp"),
    }).drop("_m")


def with_chunk(rows: DataFrame, time: str, start: date, end: date) -> DataFrame:
    """Rows of ``[start, end)`` with the bounds of their chunk.

    A calendar month follows from the time itself, so the range join of rows and chunks
    needs neither a join nor a shuffle.
    """
    low, high = F.lit(midnight(start)), F.lit(midnight(end))
    inside = rows.where(in_window(F.col(time), low, high))
    month = F.date_trunc("month", time)
    following = F.add_months(month.cast("date"), 1).cast("timestamp")
    return inside.withColumns({
        "chunk_start": F.greatest(month, low), "chunk_end": F.least(following, high),
    })


def rows_per_chunk(rows: DataFrame, time: str, start: date, end: date) -> DataFrame:
    return with_chunk(rows, time, start, end).groupBy("chunk_start", "chunk_end").agg(
        F.count(F.lit(1)).alias("rows")
    )


def keyed_plan(plan: DataFrame, ids: list) -> DataFrame:
    """The plan with its chunk keys for an explicit station list."""
    listed = F.array(*[F.lit(i) for i in ids])
    return plan.withColumn("chunk_key", chunk_key(F.col("chunk_start"), F.col("chunk_end"), listed))


def digest_plan(plan: DataFrame, label: Column) -> DataFrame:
    """The plan with chunk keys that stand for a station table instead of a list."""
    return plan.withColumn("chunk_key", F.concat(
        iso_text(F.col("chunk_start")), F.lit("_"), iso_text(F.col("chunk_end")), F.lit("_"),
        label,
    ))


def open_chunks(plan: DataFrame, finished: DataFrame) -> DataFrame:
    """Planned chunks that have no checkpoint yet."""
    return plan.join(finished, "chunk_key", "left_anti")
