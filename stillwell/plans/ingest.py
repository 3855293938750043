"""Daily ingest of landed pages: raw rows appended, cursors advanced."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stillwell.operators.audit import (
    advanced_cursors, fetch_outcomes, ingest_stats, require_no_fatal, require_some_success,
)
from stillwell.functions import millis_to_seconds
from stillwell.operators.filters import from_cursor, only_stations
from stillwell.operators.joins import lookup_join
from stillwell.session import pin, settle
from stillwell.sinks import state as progress
from stillwell.sinks.raw import land, load_folder, new_load_id, replace_stations
from stillwell.sinks.zone import Zone
from stillwell.sources.landing import (
    attributes, city_readings, damaged_pages, distinct_stations, flatten_stations, logger_readings,
)
from stillwell.sources.scan import read_or_empty, scan_written
from stillwell.sources.specs import SourceSpec


def allowed_outcomes(stations: DataFrame, log: DataFrame, allowed) -> DataFrame:
    """One outcome per listed station; a station outside the allowlist is ``skipped``."""
    every = stations.select(F.col("id").cast("string").alias("location_id"))
    if not isinstance(allowed, DataFrame):
        allowed = [str(i) for i in allowed]
    wanted = only_stations(every, allowed).withColumn("_in", F.lit(True))
    fetched = fetch_outcomes(log).select("location_id", "outcome")
    joined = every.join(wanted, "location_id", "left").join(fetched, "location_id", "left")
    return joined.select(
        "location_id",
        F.when(F.col("_in").isNull(), F.lit("skipped"))
        .otherwise(F.coalesce("outcome", F.lit("error"))).alias("outcome"),
    )


def with_damage(outcomes: DataFrame, pages: DataFrame) -> DataFrame:
    """Outcomes, with ``error`` for stations of which a page arrived damaged.

    A damaged line that does not name its station fails the run: it may belong to any.
    """
    damaged = settle(damaged_pages(pages))
    unnamed = damaged.where(F.col("location_id").isNull()).first()
    if unnamed:
        raise RuntimeError(f"{unnamed['pages']} damaged page(s) without a station")
    marks = damaged.select(F.col("location_id").cast("string").alias("location_id"), "pages")
    return lookup_join(outcomes, marks, "location_id").select(
        "location_id",
        F.when((F.col("outcome") == "ok") & F.col("pages").isNotNull(), F.lit("error"))
        .otherwise(F.col("outcome")).alias("outcome"),
    )


def claimed_load(spark: SparkSession, place: str) -> float:
    """The load id of this ingest, noted beside the progress before anything is written.

    An attempt that failed before its commit left the progress as it was, so the next one
    finds its id again and replaces its load. Any commit in between makes the id a new one.
    """
    snapshot = progress.latest_snapshot(spark, place)
    snapshot = -1 if snapshot is None else int(snapshot)
    shape = T.StructType([T.StructField("snapshot", T.LongType()),
                          T.StructField("load_id", T.DoubleType())])
    noted = read_or_empty(spark, f"{place}-pending", shape)
    row = noted.where(F.col("snapshot") == snapshot).first()
    if row:
        return row["load_id"]
    load_id = new_load_id()
    spark.createDataFrame([(snapshot, load_id)], shape).coalesce(1).write.mode(
        "overwrite").parquet(f"{place}-pending")
    return load_id


def run_ingest(
    spark: SparkSession, spec: SourceSpec, zone: Zone, *, station_list: DataFrame,
    pages: DataFrame, log: DataFrame, allowed: list, start_ts: int,
) -> dict:
    """Land the pages of every successfully fetched station of the allowlist.

    Readings count from the station's cursor or ``start_ts``. Nothing is written unless a
    station was fetched. Cursors advance only after the rows are written.
    """
    pin(spark)
    place = zone.progress(spec.dataset)
    outcomes = settle(with_damage(allowed_outcomes(station_list, log, allowed), pages))
    require_no_fatal(outcomes)
    require_some_success(ingest_stats(outcomes))
    fetched = outcomes.where(F.col("outcome") == "ok").select(
        F.col("location_id").cast("bigint").alias("location_id")
    )
    old = progress.cursors(progress.read_state(spark, place), spec.dataset)
    floors = old.withColumn("location_id", F.col("location_id").try_cast("bigint"))
    rows = logger_readings(lookup_join(pages, fetched, "location_id", "left_semi"))
    rows = from_cursor(rows, floors.where(F.col("location_id").isNotNull()), start_ts)
    replace_stations(flatten_stations(station_list), zone.stations(spec))
    landed = land(rows.select(*spec.schema.names), zone.raw(spec), claimed_load(spark, place))
    load_id = landed.load_id
    written = scan_written(spark, load_folder(zone.raw(spec), load_id), spec.schema)
    moved = advanced_cursors(
        written, outcomes.join(old, "location_id", "left"), start_ts
    )
    stats = ingest_stats(outcomes, landed.rows).first().asDict()
    progress.commit_state(
        spark, place, progress.cursor_rows(moved, spec.dataset), f"ingest-{load_id:.6f}"
    )
    return {**stats, "load_id": load_id}


def run_city_ingest(
    spark: SparkSession, spec: SourceSpec, zone: Zone, *, features: DataFrame,
    station_features: DataFrame, log: DataFrame, start_ts: int,
) -> dict:
    """Land the measurements of every successfully fetched city station.

    Measurements count from midnight of the station's cursor, inclusive, so the raw table
    holds repeats; the watermark at load time removes them.
    """
    pin(spark)
    place = zone.progress(spec.dataset)
    stations = settle(distinct_stations(attributes(station_features)))
    codes = stations.select(F.col("sys_loc_code").alias("location_id")).distinct()
    outcomes = settle(
        codes.join(fetch_outcomes(log).select("location_id", "outcome"), "location_id", "left")
        .withColumn("outcome", F.coalesce("outcome", F.lit("error")))
    )
    require_no_fatal(outcomes)
    require_some_success(ingest_stats(outcomes))
    ok = outcomes.where(F.col("outcome") == "ok").select(
        F.col("location_id").alias("sys_loc_code")
    )
    old = progress.cursors(progress.read_state(spark, place), spec.dataset)
    second = millis_to_seconds(F.col("measurement_date"))
    measured = lookup_join(attributes(features), ok, "sys_loc_code", "left_semi")
    recent = from_cursor(
        measured, old.withColumnRenamed("location_id", "sys_loc_code"), start_ts,
        station="sys_loc_code", seconds=second, by_day=True,
    )
    landed = land(city_readings(recent, stations), zone.raw(spec), claimed_load(spark, place))
    load_id = landed.load_id
    written = scan_written(spark, load_folder(zone.raw(spec), load_id), spec.schema)
    moved = advanced_cursors(
        written, outcomes.join(old, "location_id", "left"), start_ts,
        seconds=millis_to_seconds(F.col("timestamp")),
    )
    stats = ingest_stats(outcomes, landed.rows).first().asDict()
    progress.commit_state(
        spark, place, progress.cursor_rows(moved, spec.dataset), f"ingest-{load_id:.6f}"
    )
    return {**stats, "load_id": load_id}
