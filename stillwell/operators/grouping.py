"""One row per key, chosen by an explicit order.

Where keys repeat often, the aggregate combines them before the shuffle. Where nearly every
row has a key of its own nothing would combine, and one shuffle with one sort is cheaper.
"""

from pyspark.sql import DataFrame, Window, functions as F


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key in ``order``, whole."""
    rest = [name for name in df.columns if name not in keys]
    # Wrapping in a struct keeps a null inside the chosen row, which max_by alone would skip.
    chosen = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, *[f"_row.{name}" for name in rest])


def unique_readings(readings: DataFrame, order: list[str]) -> DataFrame:
    """One row per ``reading_id``: the last arrival. Rows without an id are all kept."""
    latest = Window.partitionBy("reading_id").orderBy(*[F.desc(name) for name in order])
    place = "_place"
    named = readings.where(F.col("reading_id").isNotNull())
    first = named.withColumn(place, F.row_number().over(latest)).where(
        F.col(place) == 1).drop(place)
    return first.unionByName(readings.where(F.col("reading_id").isNull())).select(
        "reading_id", *[name for name in readings.columns if name != "reading_id"])
