"""Replay: map stored raw rows of an event-time range again and replace that window."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell.operators.audit import outcome_totals
from stillwell.operators.filters import in_window
from stillwell.operators.grouping import unique_readings
from stillwell.operators.joins import settle_measured
from stillwell.operators.mapping import good_rows
from stillwell.session import pin, settle
from stillwell.sinks import state as progress
from stillwell.sinks.observations import replace_window_in_place
from stillwell.sinks.raw import loads_meeting
from stillwell.sinks.zone import Zone
from stillwell.sources.scan import scan_new
from stillwell.sources.specs import ARRIVAL, SourceSpec


def replayed(
    spec: SourceSpec, raw: DataFrame, start: int, end: int, *, unique: bool = False
) -> DataFrame:
    """Observations of raw rows with an event time in ``[start, end)``, in the source's unit.

    Readings without a time stay in, since nothing says that they lie outside: they fail their
    station, as they do in the daily job and in a backfill. ``unique`` keeps the last arrival of
    each reading, since the raw zone may hold repeats. Raw rows are read once.
    """
    rows = raw.where(F.col("timestamp").isNull() | in_window(F.col("timestamp"), start, end))
    if unique:
        rows = unique_readings(rows, ARRIVAL)
    flagged = settle(spec.flagged(rows))
    outcomes, small, seen = settle_measured(spec.outcomes(flagged), *outcome_totals())
    if seen["adapter_failures"]:
        flagged = good_rows(flagged, outcomes, small=small or None)
    return spec.observations(flagged)


def run_replay(
    spark: SparkSession, spec: SourceSpec, zone: Zone, start: datetime, end: datetime,
    *, run_key: str, per_second: int = 1, unique: bool = True,
) -> DataFrame:
    """Replace ``[start, end)`` from the raw zone; ``per_second`` is 1000 for milliseconds.

    Only loads whose event times meet the window are opened.
    """
    pin(spark)
    low, high = (int(t.timestamp()) * per_second for t in (start, end))
    raw = scan_new(spark, loads_meeting(spark, zone.raw(spec), low, high), spec.schema)
    obs = replayed(spec, raw, low, high, unique=unique)
    marks = progress.watermarks(progress.read_state(spark, zone.progress(spec.dataset)), spec.dataset)
    done = settle(replace_window_in_place(
        spark, zone.observations, spec.agency, f"replay-{run_key}", obs, start, end, marks
    ))
    progress.commit_state(
        spark, zone.progress(spec.dataset),
        progress.watermark_rows(done, spec.dataset, "new_watermark"), f"replay-{run_key}",
    )
    return done
