"""Run statistics and pass/fail rules, computed from logs and results."""

from pyspark.sql import Column, DataFrame, functions as F

from stillwell.operators.grouping import last_per_key
from stillwell.operators.filters import start_floor
from stillwell.operators.mapping import is_failed


def _zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("bigint")


# --- fetch log -------------------------------------------------------------------------
def outcome(status: Column, error: Column) -> Column:
    """ok, no_data (404), error (429 used up, 5xx, network) or fatal (any other status)."""
    return (
        F.when(status.isNull() | error.isNotNull(), F.lit("error"))
        .when(status.between(200, 299), F.lit("ok"))
        .when(status == 404, F.lit("no_data"))
        .when((status == 429) | (status >= 500), F.lit("error"))
        .otherwise(F.lit("fatal"))
    )


def fetch_outcomes(log: DataFrame) -> DataFrame:
    """One outcome per station: that of its last attempt."""
    last = last_per_key(log, ["location_id"], ["attempt"])
    return last.withColumn("outcome", outcome(F.col("status"), F.col("error")))


def require_no_fatal(outcomes: DataFrame) -> None:
    row = outcomes.where(F.col("outcome") == "fatal").agg(
        F.count(F.lit(1)).alias("n"), F.min("location_id").alias("first")
    ).first()
    if row["n"]:
        raise RuntimeError(f"{row['n']} fetch(es) refused by the vendor, first: {row['first']}")


def ingest_stats(outcomes: DataFrame, rows: int | Column = 0) -> DataFrame:
    """Totals of an ingest run. ``outcomes`` may hold ``skipped`` for stations not asked for."""
    return ingest_stats_by(outcomes, [], rows)


def ingest_stats_by(outcomes: DataFrame, keys: list[str], rows: int | Column = 0) -> DataFrame:
    """The same totals per group of stations."""
    def of(kind):
        return F.count_if(F.col("outcome") == kind)

    return outcomes.groupBy(*keys).agg(
        (F.lit(rows) if isinstance(rows, int) else rows).cast("bigint").alias("rows_yielded"),
        of("ok").alias("locations_fetched"), of("skipped").alias("locations_skipped"),
        of("no_data").alias("locations_no_data"), of("error").alias("locations_errored"),
    )


def failed_fetches(outcomes: DataFrame) -> DataFrame:
    """Ids of the stations that errored, sorted; a table, since there may be many."""
    failed = outcomes.where(F.col("outcome") == "error")
    return failed.select("location_id").orderBy("location_id")


def all_failed() -> Column:
    """Whether an ingest with these statistics counts as failed: errors, and nothing fetched."""
    return (F.col("locations_errored") > 0) & (F.col("locations_fetched") == 0)


def require_some_success(stats: DataFrame) -> None:
    """An ingest fails when stations errored and none was fetched."""
    row = stats.withColumn("_failed", all_failed()).first()
    if row["_failed"]:
        raise RuntimeError(f"all fetches failed ({row['locations_errored']} errored, 0 fetched)")


def advanced_cursors(
    readings: DataFrame, fetched: DataFrame, start_ts: int, *, seconds: Column | None = None
) -> DataFrame:
    """New cursor per successfully fetched station: its latest second, never below its floor.

    ``fetched`` has ``location_id``, ``outcome`` and the previous ``cursor``. Stations that
    failed do not appear, so their old cursor stands.
    """
    time = F.col("timestamp") if seconds is None else seconds
    floors = fetched.where(F.col("outcome") == "ok").select(
        F.col("location_id").cast("string"),
        start_floor(start_ts, F.col("cursor")).alias("position"), F.lit(True).alias("ok"),
    )
    seen = readings.groupBy(F.col("location_id").cast("string").alias("location_id")).agg(
        F.max(time).cast("bigint").alias("position"), F.lit(False).alias("ok")
    )
    merged = floors.unionByName(seen).groupBy("location_id").agg(
        F.max("position").alias("cursor"), F.max("ok").alias("ok")
    )
    return merged.where("ok").drop("ok")


# --- transform and load ----------------------------------------------------------------
def outcome_totals() -> list[Column]:
    """Totals over station outcomes."""
    failed = is_failed()
    return [
        _zero(F.sum("rows")).alias("rows_read"),
        F.count(F.lit(1)).alias("locations_grouped"),
        F.count_if(~failed).alias("bundles_produced"),
        F.count_if(failed).alias("adapter_failures"),
    ]


def transform_stats(
    outcomes: DataFrame, before: float | None, after: float | None
) -> DataFrame:
    """Totals over station outcomes, with the load id before and after."""
    return outcomes.agg(
        *outcome_totals(),
        F.lit(before).cast("double").alias("watermark_before"),
        F.lit(after).cast("double").alias("watermark_after"),
    )


def result_totals() -> list[Column]:
    """Totals over the load results of datastreams."""
    return [
        _zero(F.sum("posted")).alias("observations_posted"),
        _zero(F.sum("skipped")).alias("observations_skipped"),
        _zero(F.sum("deleted")).alias("observations_deleted"),
    ]


def load_totals(results: DataFrame, bundles: int) -> DataFrame:
    return results.agg(F.lit(bundles).cast("bigint").alias("bundles_loaded"), *result_totals())


def chunk_totals(chunks: DataFrame) -> DataFrame:
    """Field-wise sums over chunk results; zeros when there are none."""
    names = ["rows_ingested", "bundles_loaded", "observations_posted",
             "observations_deleted", "adapter_failures"]
    return chunks.agg(*[_zero(F.sum(name)).alias(name) for name in names])
