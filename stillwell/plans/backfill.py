"""Backfill: month chunks of landed pages, each replacing its window, with resume."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillwell import schemas
from stillwell.files import exists
from stillwell.operators.audit import fetch_outcomes
from stillwell.operators.grouping import last_per_key
from stillwell.operators.joins import settle_measured
from stillwell.operators.mapping import good_rows, is_failed
from stillwell.plans.months import digest_plan, keyed_plan, month_plan, with_chunk
from stillwell.session import pin, settle, settle_observed
from stillwell.sinks import state as progress
from stillwell.sinks.entities import upsert_entities
from stillwell.sinks.observations import replace_window_in_place
from stillwell.sinks.raw import append_loads, load_folder, new_load_id
from stillwell.sinks.zone import Zone
from stillwell.sources.landing import DAMAGED, damaged_pages, windows_readings
from stillwell.sources.scan import scan_new
from stillwell.sources.specs import SourceSpec

WAVE = 12
Fetch = Callable[[object, object], tuple[DataFrame, DataFrame | None]]


def unknown_ids(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested ids the station table does not have."""
    return requested.join(known, requested.columns[0], "left_anti")


def resolve_ids(spark: SparkSession, requested: list, stations: DataFrame) -> DataFrame:
    """Station ids of a backfill: the requested ones, or every known one if none is named."""
    known = stations.select(F.col("id").alias("location_id"))
    if not requested:
        return known.distinct()
    kind = known.schema["location_id"].dataType.simpleString()
    listed = spark.createDataFrame([(i,) for i in requested], f"location_id {kind}")
    missing = [r[0] for r in unknown_ids(listed, known).distinct().orderBy("location_id").collect()]
    if missing:
        raise ValueError(f"unknown location id(s): {missing}")
    return listed


def plan_chunks(
    spark: SparkSession, start: date, end: date, requested: list, ids: DataFrame
) -> DataFrame:
    """The keyed month plan. Without an explicit list the key holds a digest of all ids."""
    plan = month_plan(spark, start, end)
    if requested:
        return keyed_plan(plan, requested)
    row = _digest(ids).first()
    return digest_plan(plan, F.lit(f"all:{row['n']}:{row['h']}"))


def finished_for_all(
    finished: set[str], ids: DataFrame
) -> set[tuple[str, str]]:
    """(start, end) of finished chunks whose key lists just these stations, as deployments that
    named every station in the key left them. Keys and stations are compared by count and digest."""
    listed = [k.split("_", 2) for k in finished if k.count("_") >= 2 and "_all:" not in k]
    if not listed:
        return set()
    spark, kind = ids.sparkSession, ids.schema["location_id"].dataType
    row = _digest(ids).first()
    keys = spark.createDataFrame([tuple(k) for k in listed], "s string, e string, list string")
    hashes = F.transform(F.split("list", ","), lambda i: F.xxhash64(i.try_cast(kind)))
    digest = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))
    same = keys.where((F.size(hashes) == row["n"]) & (digest == row["h"]))
    return {(r["s"], r["e"]) for r in same.select("s", "e").collect()}


def _digest(ids: DataFrame) -> DataFrame:
    return ids.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("location_id")), F.lit(0)).alias("h"),
    )


def dry_run(
    spark: SparkSession, start: date, end: date, requested: list, stations: DataFrame
) -> DataFrame:
    """What a run would do, one row per chunk; nothing is written."""
    ids = resolve_ids(spark, requested, stations)
    plan = plan_chunks(spark, start, end, requested, ids)
    return plan.withColumn("locations", F.lit(ids.count()).cast("bigint"))


def dry_run_counts(spec: SourceSpec, raw: DataFrame, start: date, end: date) -> DataFrame:
    """Rows, and observations a load would post, per chunk of stored raw rows.

    Stations fail per chunk, as they do when each chunk is loaded on its own.
    """
    timed = with_chunk(
        spec.flagged(raw).withColumn("phenomenon_time", spec.time()), "phenomenon_time", start, end
    )
    per_station = timed.groupBy("chunk_start", "chunk_end", "location_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("failure").isNotNull() | F.col("location_id").isNull()).alias("bad"),
    )
    return per_station.groupBy("chunk_start", "chunk_end").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("bad") == 0, F.col("rows")).otherwise(0)).alias("observations"),
        F.count_if(F.col("bad") > 0).alias("failed_stations"),
    )


@dataclass(frozen=True)
class Chunk:
    """An open chunk of the plan, and what was fetched for it."""

    key: str
    start: datetime
    end: datetime
    pages: DataFrame
    log: DataFrame | None
    load_id: float

    @property
    def window(self) -> Column:
        return F.struct(F.lit(int(self.start.timestamp())).alias("start"),
                        F.lit(int(self.end.timestamp())).alias("end"))


def faults(chunks: list[Chunk]) -> dict[str, str]:
    """Why chunks may not be loaded: any station that failed to fetch, any damaged page. All
    logs and pages are judged by one query, which returns a row per kind and chunk."""
    found = []
    for chunk in chunks:
        if DAMAGED in chunk.pages.columns:
            found.append(damaged_pages(chunk.pages).select(
                F.lit("damaged").alias("outcome"), "pages",
                F.col("location_id").cast("string").alias("location_id"),
                F.lit(chunk.key).alias("chunk")))
        if chunk.log is not None:
            found.append(fetch_outcomes(chunk.log).select(
                "outcome", F.lit(1).cast("bigint").alias("pages"),
                F.col("location_id").cast("string").alias("location_id"),
                F.lit(chunk.key).alias("chunk")))
    if not found:
        return {}
    rows = reduce(DataFrame.unionByName, found).where(
        F.col("outcome").isin("damaged", "error", "fatal")).groupBy("chunk", "outcome").agg(
        F.sum("pages").alias("n"), F.min("location_id").alias("first")).collect()
    says = {"fatal": "{n} fetch(es) refused by the vendor, first: {first}",
            "error": "{n} station(s) failed to fetch", "damaged": "{n} damaged page(s)"}
    out = {}
    for kind in ("damaged", "error", "fatal"):
        out |= {r["chunk"]: says[kind].format(n=r["n"], first=r["first"])
                for r in rows if r["outcome"] == kind}
    return out


def land_chunks(spec: SourceSpec, zone: Zone, chunks: list[Chunk], ids: DataFrame) -> None:
    """Land all chunks in one scan of their pages, one load each. The cut-off and the rows both
    need the pages, which are fetched once."""
    pages = settle(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        c.pages.select("location_id", "page", "payload", c.window.alias("window"))
        for c in chunks]))
    loads = F.create_map(*[x for c in chunks for x in (c.window, F.lit(c.load_id))])
    rows = windows_readings(pages, ids, "window")
    append_loads(rows.withColumn("load_id", loads[F.col("window")]).drop("window"),
                 zone.backfill(spec), named=[c.load_id for c in chunks])


def run_chunks(
    spark: SparkSession, spec: SourceSpec, zone: Zone, chunks: list[Chunk], *, ids: DataFrame,
    stations: DataFrame, run_key: str, clear_requested: bool = False,
) -> list[tuple]:
    """Land and judge chunks together, then replace their windows one by one, each committed
    with its watermarks after its data. Returns the counts of each chunk."""
    land_chunks(spec, zone, chunks, ids)
    folders = {c.load_id: load_folder(zone.backfill(spec), c.load_id) for c in chunks}
    held = [f for f in folders.values() if exists(spark, f)]
    flagged = spec.flagged(scan_new(spark, held, spec.schema))
    outcomes, small, _ = settle_measured(spec.outcomes(flagged, ("load_id",)))
    small = small or None
    per_load = {r["load_id"]: r for r in outcomes.groupBy("load_id").agg(
        F.sum("rows").alias("rows"), F.count_if(~is_failed()).alias("good"),
        F.count_if(is_failed()).alias("bad")).collect()}
    if any(r["good"] for r in per_load.values()):
        passed = outcomes.where(~is_failed())
        rest = [c for c in passed.columns if c != "location_id"]
        once = passed.groupBy("location_id").agg(
            F.min_by(F.struct(*rest), "load_id").alias("_first")).select("location_id", "_first.*")
        described = settle(spec.stations(once, stations, small))
        upsert_entities(spark, zone, spec.entities(described))
    scope, place = f"{spec.dataset}_backfill", zone.progress(f"{spec.dataset}_backfill")
    marks, few, _ = settle_measured(progress.watermarks(progress.read_state(spark, place), scope))
    keys = ids.select(spec.stream_key().alias("datastream_key")) if clear_requested else None
    results = []
    for chunk in chunks:
        seen = per_load.get(chunk.load_id)
        rows, good, bad = (seen["rows"], seen["good"], seen["bad"]) if seen else (0, 0, 0)
        line = spark.createDataFrame([(chunk.key,)], "chunk_key string").coalesce(1)
        updates, posted, deleted = progress.chunk_rows(line, run_key), 0, 0
        if good or clear_requested:
            own = spec.flagged(scan_new(
                spark, [f for f in [folders[chunk.load_id]] if f in held], spec.schema))
            if bad:
                failed = outcomes.where(F.col("load_id") == chunk.load_id)
                own = good_rows(own, failed, small=small)
            done, sums = settle_observed(replace_window_in_place(
                spark, zone.observations, spec.agency, f"backfill-{run_key}",
                spec.observations(own), chunk.start, chunk.end, marks, keys, few_marks=few,
            ), F.sum("posted").alias("posted"), F.sum("deleted").alias("deleted"))
            posted, deleted = sums["posted"] or 0, sums["deleted"] or 0
            updates = updates.unionByName(progress.watermark_rows(done, scope, "new_watermark"))
        progress.commit_state(spark, place, updates, chunk.key)
        results.append((rows, good, posted, deleted, bad))
    return results


def run_backfill(
    spark: SparkSession, spec: SourceSpec, zone: Zone, *, start: date, end: date,
    run_key: str, fetch: Fetch, stations: DataFrame, requested: list | None = None,
    clear_requested: bool = False,
) -> dict:
    """Run every open chunk of the plan in order; each commits once it is complete.

    ``fetch(start, end)`` gives the landed pages of a window and their fetch log. Up to ``WAVE``
    chunks are judged, landed and described together. A fetch error of any station fails its whole
    chunk, after the chunks before it. Chunk state and watermarks commit together, after the data,
    so a failed chunk is open again.
    """
    pin(spark)
    # Of a station listed twice the last row counts.
    listed = stations.withColumn("_row", F.monotonically_increasing_id())
    stations = settle(last_per_key(listed, ["id"], ["_row"]).select(*stations.columns))
    requested = list(spec.default_ids if requested is None else requested)
    ids = settle(resolve_ids(spark, requested, stations))
    plan = plan_chunks(spark, start, end, requested, ids)
    place = zone.progress(f"{spec.dataset}_backfill")
    finished = {key for scope, _, key in progress.positions(spark, place, progress.CHUNK)
                if scope == run_key}
    # One row per month of the requested range.
    every = plan.select("chunk_key", F.unix_seconds("chunk_start").alias("s"),
                        F.unix_seconds("chunk_end").alias("e")).collect()
    whole = set() if requested else finished_for_all(finished, ids)
    todo = sorted((r for r in every if r["chunk_key"] not in finished
                   and tuple(r["chunk_key"].split("_", 2)[:2]) not in whole), key=lambda r: r["s"])
    planned = len(every)
    results, fault, base = [], None, new_load_id()
    for at in range(0, len(todo), WAVE):
        wave = []
        for i, row in enumerate(todo[at:at + WAVE]):
            low, high = _instant(row["s"]), _instant(row["e"])
            wave.append(Chunk(row["chunk_key"], low, high, *fetch(low, high),
                              round(base + (at + i) * 1e-6, 6)))
        bad = faults(wave)
        fault = next(((c, bad[c.key]) for c in wave if c.key in bad), None)
        sound = wave[:wave.index(fault[0])] if fault else wave
        if sound:
            results += run_chunks(spark, spec, zone, sound, ids=ids, stations=stations,
                                  run_key=run_key, clear_requested=clear_requested)
        if fault:
            raise RuntimeError(f"{fault[1]} in [{fault[0].start}, {fault[0].end})")
    totals = {name: sum(r[i] for r in results) for i, name in enumerate(schemas.CHUNK_TOTALS.names)}
    return {**totals, "chunks_processed": len(todo), "chunks_skipped": planned - len(todo)}


def _instant(seconds: int) -> datetime:
    return datetime.fromtimestamp(seconds, timezone.utc)
