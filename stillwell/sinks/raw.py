"""Raw-zone writers. Beside the loads stands a map of their event times, so that a replay opens
only loads that meet its window."""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stillwell.session import observed
from stillwell.sinks.state import commit_state, positions
from stillwell.sources.scan import load_folder, named_loads

EARLIEST, LATEST, TIMELESS = "earliest", "latest", "timeless"


@dataclass(frozen=True)
class Landed:
    """A load and what its own write counted."""

    load_id: float
    rows: int
    earliest: int | None
    latest: int | None
    timeless: int


def new_load_id() -> float:
    """Epoch seconds with microseconds, the identity of one load."""
    return round(datetime.now(timezone.utc).timestamp(), 6)


def _bounds() -> list:
    return [F.min("timestamp").cast("bigint").alias(EARLIEST),
            F.max("timestamp").cast("bigint").alias(LATEST),
            F.count_if(F.col("timestamp").isNull()).alias(TIMELESS)]


def _note(spark: SparkSession, root: str, bounds: DataFrame) -> None:
    """Add to the map: a load that is written again can only widen its bounds, as positions grow."""
    kinds = F.create_map(F.lit(LATEST), F.col(LATEST), F.lit(EARLIEST), -F.col(EARLIEST),
                         F.lit(TIMELESS), F.col(TIMELESS))
    rows = bounds.select(F.lit("").alias("scope"), F.col("load").alias("key"),
                         F.explode(kinds).alias("kind", "position"))
    commit_state(spark, f"{root}_bounds", rows.where(F.col("position").isNotNull()).coalesce(1))


FOLDERS = ["year", "month", "day", "load_id"]


def _placed(rows: DataFrame, load_id: str) -> DataFrame:
    """Rows dealt by their load alone; folder names follow from it and are not shuffled."""
    when = F.timestamp_seconds(F.col(load_id))
    return rows.hint("rebalance", F.col(load_id)).withColumns({
        "year": F.date_format(when, "yyyy"), "month": F.date_format(when, "MM"),
        "day": F.date_format(when, "dd"),
        "load_id": F.format_string("%.6f", F.col(load_id).cast("double")),
    })


BOUNDS = f"load string, {EARLIEST} bigint, {LATEST} bigint, {TIMELESS} bigint"


def land(rows: DataFrame, root: str, load_id: float | None = None) -> Landed:
    """Write one load under its own folder, with its rows and event times counted by that write.

    Writing the folder with overwrite makes a retried load replace itself.
    """
    spark, load_id = rows.sparkSession, new_load_id() if load_id is None else load_id
    seen, counts = Observation(), [F.count(F.lit(1)).alias("rows"), *_bounds()]
    folder = load_folder(root, load_id)
    rows.observe(seen, *counts).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    landed = Landed(load_id, **observed(seen, written, *counts))
    _note(spark, root, spark.createDataFrame(
        [(f"{load_id:.6f}", landed.earliest, landed.latest, landed.timeless)], BOUNDS))
    return landed


def append_load(rows: DataFrame, root: str, load_id: float | None = None) -> float:
    return land(rows, root, load_id).load_id


def loads_meeting(spark: SparkSession, root: str, start: int, end: int) -> list[str]:
    """Loads that may hold an event time in ``[start, end)``: by the map, and those it lacks.

    Readings without a time go with their load; a load that holds no others counts always."""
    known, found = positions(spark, f"{root}_bounds", EARLIEST, LATEST, TIMELESS), []
    for path, load_id in named_loads(spark, root):
        earliest, latest, timeless = (
            known.get(("", kind, f"{load_id:.6f}")) for kind in (EARLIEST, LATEST, TIMELESS))
        if timeless is None or (timeless if latest is None else latest >= start and -earliest < end):
            found.append(path)
    return sorted(found)


def append_loads(
    rows: DataFrame, root: str, load_id: str = "load_id", *, named: list[float] | None = None
) -> None:
    """Write rows that carry their load id (seconds) as many loads in one job. If they are few
    and ``named``, the write itself counts their event times."""
    spark, seen = rows.sparkSession, Observation()
    if named is None:
        # Names are made of the few loads, not of every row; bounds of equal names merge.
        own = F.col(load_id).cast("double").alias("load")
        bounds = rows.groupBy(own).agg(*_bounds()).withColumn(
            "load", F.format_string("%.6f", "load"))
    else:
        time = [F.when(F.col(load_id) == F.lit(n), F.col("timestamp")) for n in named]
        counts = [m for i, n in enumerate(named) for m in (
            F.min(time[i]).cast("bigint").alias(f"{EARLIEST}{i}"),
            F.max(time[i]).cast("bigint").alias(f"{LATEST}{i}"),
            F.count_if((F.col(load_id) == F.lit(n)) & F.col("timestamp").isNull())
            .alias(f"{TIMELESS}{i}"))]
        rows = rows.observe(seen, *counts)
    (_placed(rows, load_id).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*FOLDERS).parquet(root))
    if named is not None:
        found = observed(seen, rows.limit(0), *counts)
        bounds = spark.createDataFrame(
            [(f"{n:.6f}", *(found[f"{kind}{i}"] for kind in (EARLIEST, LATEST, TIMELESS)))
             for i, n in enumerate(named)], BOUNDS)
    _note(spark, root, bounds)


def replace_stations(stations: DataFrame, root: str) -> None:
    """Full refresh of the station table."""
    stations.write.mode("overwrite").parquet(root)
