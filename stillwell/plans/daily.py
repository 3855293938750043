"""The daily job: new loads of one source, mapped and appended behind the watermarks."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell import schemas
from stillwell.operators.audit import outcome_totals, result_totals
from stillwell.operators.joins import settle_measured
from stillwell.operators.mapping import failed_stations, good_rows, is_failed
from stillwell.operators.watermarks import effective_watermarks, past_watermark
from stillwell.session import pin, settle, settle_observed
from stillwell.sinks import state as progress
from stillwell.sinks.entities import upsert_entities
from stillwell.sinks.observations import live_folders, newest_stored, read_summary, write_batch
from stillwell.sinks.zone import Zone
from stillwell.sources.scan import newest_of, paths_since, scan_new, scan_stations
from stillwell.sources.specs import SourceSpec


def station_table(spark: SparkSession, spec: SourceSpec, zone: Zone) -> DataFrame | None:
    root = zone.stations(spec)
    if root is None:
        return None
    return scan_stations(spark, root, schemas.LOGGER_STATIONS)


def load_batch(
    spark: SparkSession, spec: SourceSpec, zone: Zone, raw: DataFrame, *, batch: str,
    scope: str, stations: DataFrame | None = None, extra_state: DataFrame | None = None,
    before: float | None = None, after: float | None = None,
) -> dict:
    """Map ``raw`` and append what is new, then commit all progress at once.

    Two passes over ``raw``: one aggregate per station, one narrow map into the target.
    Nothing is committed if any step raises, so the same batch can simply run again; it must
    not run again once committed (``run_daily`` and ``run_stream`` see to that).
    """
    place = zone.progress(scope)
    flagged = spec.flagged(raw)
    outcomes, small, seen = settle_measured(spec.outcomes(flagged), *outcome_totals())
    small = small or None  # unknown for what derives from many outcomes
    stats = {c: n for c, n in seen.items() if not c.startswith("_")}
    stats |= {"watermark_before": before, "watermark_after": after}
    quarantined = failed_stations(outcomes).select("location_id", "failure", "bad_rows")
    updates, results = extra_state, None
    loaded = {"observations_posted": 0, "observations_skipped": 0, "observations_deleted": 0}
    if stats["bundles_produced"]:
        passed = outcomes.where(~is_failed())
        if stations is None:
            stations = station_table(spark, spec, zone)
        described = settle(spec.stations(passed, stations, small))
        upsert_entities(spark, zone, spec.entities(described))
        considered = passed.select(
            spec.stream_key().alias("datastream_key"), F.col("rows").alias("considered")
        )
        stored = progress.watermarks(progress.read_state(spark, place), scope)
        # Rows an earlier attempt of this batch left behind do not count as loaded.
        marks = effective_watermarks(
            considered.select("datastream_key"), stored,
            lambda: newest_stored(spark, zone.observations, spec.agency, without_batch=batch),
        )
        # Most batches have no failed station, and then nothing has to be joined away.
        good = good_rows(flagged, outcomes, small=small) if stats["adapter_failures"] else flagged
        fresh = past_watermark(spec.observations(good), marks, small=small)
        written = write_batch(fresh, zone.observations, spec.agency, batch).groupBy(
            "datastream_key").agg(F.sum("rows").alias("posted"), F.max("newest").alias("newest"))
        posted = F.coalesce("posted", F.lit(0)).cast("bigint")
        results, loaded = settle_observed(
            considered.join(written, "datastream_key", "left")
            .join(marks, "datastream_key", "left")
            .select(
                "datastream_key", "considered", posted.alias("posted"),
                (F.col("considered") - posted).alias("skipped"),
                F.lit(0).cast("bigint").alias("deleted"),
                F.greatest("newest", "watermark").alias("new_watermark"),
            ),
            *result_totals(),
        )
        # A watermark recovered from the target is not stored while nothing new was posted.
        moved = progress.watermark_rows(
            results.where(F.col("posted") > 0), scope, "new_watermark"
        )
        updates = moved if updates is None else updates.unionByName(moved)
    if updates is not None:
        progress.commit_state(spark, place, updates, batch)
    return {**stats, "bundles_loaded": stats["bundles_produced"], **loaded,
            "results": results, "quarantined": quarantined}


def run_daily(spark: SparkSession, spec: SourceSpec, zone: Zone) -> dict:
    """Process every load newer than the last committed one, wherever its files lie.

    The batch is named after the committed load it starts from: an attempt that failed
    before its commit is overwritten by the next, even if more loads arrived meanwhile.
    """
    pin(spark)
    place = zone.progress(spec.dataset)
    marks = progress.positions(spark, place, progress.ORIGIN, progress.LOAD)
    origin, last = progress.origin(spark, place, marks), progress.last_of(marks, spec.dataset)
    since = None if last is None else last / 1e6
    paths = paths_since(spark, zone.raw(spec), since)
    newest = newest_of(spark, paths, since)
    if newest is None or newest == since:
        return {"rows_read": 0, "bundles_loaded": 0, "observations_posted": 0,
                "observations_skipped": 0, "watermark_before": since, "watermark_after": newest,
                "results": None}
    raw = scan_new(spark, paths, spec.schema, since, until=newest)
    batch = f"daily-{origin}-{0 if since is None else since:.6f}"
    mark = progress.load_rows(spark, spec.dataset, newest)
    return load_batch(
        spark, spec, zone, raw, batch=batch, scope=spec.dataset, extra_state=mark,
        before=since, after=newest,
    )


def recovered_watermarks(spark: SparkSession, zone: Zone) -> DataFrame:
    """Watermarks rebuilt from the target alone, that is from its summaries."""
    root = zone.observations
    return read_summary(spark, root, live_folders(spark, root)).groupBy("datastream_key").agg(
        F.max("newest").alias("watermark"))
