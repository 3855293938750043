from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.operators.audit import chunk_totals
from stillwell.plans import backfill, months
from stillwell.plans.backfill import dry_run, plan_chunks, resolve_ids, run_backfill
from stillwell.sinks import state as progress
from stillwell.sinks.observations import read_observations
from stillwell.sources import scan
from stillwell.sources.specs import LOGGERS


def plan(spark, start, end):
    rows = months.month_plan(spark, date.fromisoformat(start), date.fromisoformat(end))
    return [(r["chunk_start"].strftime("%m-%d"), r["chunk_end"].strftime("%m-%d"))
            for r in rows.orderBy("chunk_start").collect()]


@pytest.mark.parametrize("start, end, chunks", [
    ("2026-01-01", "2026-02-01", [("01-01", "02-01")]),
    ("2026-01-01", "2026-04-01", [("01-01", "02-01"), ("02-01", "03-01"), ("03-01", "04-01")]),
    ("2026-01-15", "2026-03-01", [("01-15", "02-01"), ("02-01", "03-01")]),
    ("2026-01-01", "2026-02-15", [("01-01", "02-01"), ("02-01", "02-15")]),
    ("2026-01-05", "2026-01-20", [("01-05", "01-20")]),
    ("2025-12-01", "2026-02-01", [("12-01", "01-01"), ("01-01", "02-01")]),
])
def test_month_plans(spark, start, end, chunks):
    assert plan(spark, start, end) == chunks


@pytest.mark.parametrize("start, end", [("2026-01-01", "2026-01-01"), ("2026-02-01", "2026-01-01")])
def test_empty_ranges_are_errors(spark, start, end):
    with pytest.raises(ValueError):
        plan(spark, start, end)


def test_chunk_of_a_row_equals_the_planned_chunk(spark):
    times = spark.range(0, 120).select(
        (F.timestamp_seconds(F.lit(1764547200) + F.col("id") * 86400)).alias("t"))
    start, end = date(2025, 12, 10), date(2026, 3, 5)
    got = {(r["chunk_start"], r["chunk_end"]) for r in
           months.with_chunk(times, "t", start, end).collect()}
    want = {(r["chunk_start"], r["chunk_end"]) for r in
            months.month_plan(spark, start, end).collect()}
    assert got == want


def stations(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}", "", 1.0, 2.0) for i in ids], schemas.LOGGER_STATIONS)


def test_ids_resolve(spark):
    known = stations(spark, 222, 111)
    assert sorted(r[0] for r in resolve_ids(spark, [], known).collect()) == [111, 222]
    assert [r[0] for r in resolve_ids(spark, [222, 111, 222], known).collect()] == [222, 111, 222]
    with pytest.raises(ValueError, match=r"\[333, 444\]"):
        resolve_ids(spark, [444, 111, 333], known)


def test_chunk_keys_depend_on_the_ids(spark):
    known = stations(spark, 111, 222)
    def key(requested):
        ids = resolve_ids(spark, requested, known)
        return plan_chunks(spark, date(2026, 1, 1), date(2026, 2, 1), requested, ids).first()[
            "chunk_key"]
    assert key([222, 111]) == "2026-01-01T00:00:00+00:00_2026-02-01T00:00:00+00:00_111,222"
    assert key([111]) != key([111, 222]) != key([])


def test_dry_run_writes_nothing(spark, zone):
    rows = dry_run(spark, date(2026, 1, 15), date(2026, 3, 1), [111], stations(spark, 111, 222))
    assert [r["locations"] for r in rows.collect()] == [1, 1]
    assert scan.newest_load(spark, zone.backfill(LOGGERS)) is None


def test_chunk_totals(spark):
    rows = spark.createDataFrame([(10, 2, 10, 0, 1), (5, 1, 5, 3, 2)], schemas.CHUNK_TOTALS)
    assert tuple(chunk_totals(rows).first()) == (15, 3, 15, 3, 3)
    assert tuple(chunk_totals(rows.limit(0)).first()) == (0, 0, 0, 0, 0)


# --- the job ---------------------------------------------------------------------------
def seconds(text):
    return int(datetime.fromisoformat(text + "+00:00").timestamp())


def pages(spark, *rows):
    """(station, day, value) readings, one page each in time order."""
    made = [(l, i, (l, [("4", "35", False, [(seconds(t), v)])])) for i, (l, t, v) in enumerate(rows)]
    return spark.createDataFrame(made, schemas.READING_PAGE)


def target(spark, zone):
    return sorted((r["datastream_key"], r["phenomenon_time"].strftime("%m-%d"), round(r["result"], 2))
                  for r in read_observations(spark, zone.observations).collect())


def run(spark, zone, fetch, **more):
    args = dict(start=date(2026, 1, 1), end=date(2026, 3, 1), run_key="r",
                stations=stations(spark, 111, 222), requested=[111, 222], fetch=fetch)
    return run_backfill(spark, LOGGERS, zone, **{**args, **more})


def test_backfill_runs_each_chunk_once(spark, zone):
    asked = []

    def fetch(start, _end):
        asked.append(start.month)
        return pages(spark, (111, "2026-01-05", 1.0), (222, "2026-02-05", 2.0),
                     (222, "2026-03-05", 2.0)), None

    first = run(spark, zone, fetch)
    assert (first["chunks_processed"], first["observations_posted"]) == (2, 2)
    assert target(spark, zone) == [("pvacd-111-dtw", "01-05", 3.28), ("pvacd-222-dtw", "02-05", 6.56)]
    again = run(spark, zone, fetch)
    assert (again["chunks_processed"], again["chunks_skipped"]) == (0, 2)
    assert asked == [1, 2]
    # The daily raw table and the daily watermarks stay untouched.
    assert scan.newest_load(spark, zone.raw(LOGGERS)) is None
    assert progress.latest_snapshot(spark, zone.progress("raw_pvacd")) == 0
    marks = progress.watermarks(
        progress.read_state(spark, zone.progress("raw_pvacd_backfill")), "raw_pvacd_backfill")
    assert marks.count() == 2


def test_a_correction_replaces_and_another_list_is_another_chunk(spark, zone):
    run(spark, zone, lambda *_: (pages(spark, (111, "2026-01-05", 1.0), (111, "2026-01-06", 1.0),
                                       (222, "2026-01-05", 1.0)), None))
    report = run(spark, zone, lambda *_: (pages(spark, (111, "2026-01-05", 2.0)), None),
                 requested=[111])
    assert report["chunks_processed"] == 2
    assert (report["observations_posted"], report["observations_deleted"]) == (1, 2)
    assert target(spark, zone) == [("pvacd-111-dtw", "01-05", 6.56), ("pvacd-222-dtw", "01-05", 3.28)]


def test_stations_that_return_nothing_keep_their_window_unless_asked(spark, zone):
    run(spark, zone, lambda *_: (pages(spark, (111, "2026-01-05", 1.0)), None))
    run(spark, zone, lambda *_: (pages(spark), None), run_key="second")
    assert len(target(spark, zone)) == 1
    run(spark, zone, lambda *_: (pages(spark), None), run_key="third", clear_requested=True)
    assert target(spark, zone) == []


def test_a_failed_fetch_fails_its_chunk_and_leaves_it_open(spark, zone):
    def fetch(start, _end):
        status = 200 if start.month == 1 else 503
        log = spark.createDataFrame([("111", 1, status, None)], schemas.FETCH_LOG)
        return pages(spark, (111, "2026-01-05", 1.0), (111, "2026-02-05", 1.0)), log

    with pytest.raises(RuntimeError):
        run(spark, zone, fetch)
    state = progress.read_state(spark, zone.progress("raw_pvacd_backfill"))
    assert progress.finished_chunks(state, "r").count() == 1
    healed = run(spark, zone, lambda *_: (pages(spark, (111, "2026-02-05", 1.0)), None))
    assert (healed["chunks_processed"], healed["chunks_skipped"]) == (1, 1)
    assert len(target(spark, zone)) == 2


def test_a_chunk_that_fails_on_loading_is_open_again(spark, zone, monkeypatch):
    def crash(*_args, **_kwargs):
        raise OSError("lost")

    fetch = lambda *_: (pages(spark, (111, "2026-01-05", 1.0)), None)
    with monkeypatch.context() as patch:
        patch.setattr(backfill, "replace_window_in_place", crash)
        with pytest.raises(OSError):
            run(spark, zone, fetch)
    assert run(spark, zone, fetch)["chunks_processed"] == 2
    assert len(target(spark, zone)) == 1


def test_a_bad_station_does_not_drop_the_good_one(spark, zone):
    report = run(spark, zone, lambda *_: (
        pages(spark, (111, "2026-01-05", None), (222, "2026-01-05", 1.0)), None))
    assert (report["bundles_loaded"], report["adapter_failures"]) == (1, 1)
    assert [k for k, _, _ in target(spark, zone)] == ["pvacd-222-dtw"]


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_jobs_of_a_chunk_are_few(spark, zone):
    """Chunks share one landing scan, so a further one costs its window and its commit only."""
    def fetch(start, _end):
        return pages(spark, (111, f"2026-{start.month:02}-05", 1.0),
                     (222, f"2026-{start.month:02}-06", 2.0)), None

    began = jobs(spark)
    run(spark, zone, fetch, end=date(2026, 2, 1))
    one = jobs(spark) - began
    run(spark, zone, fetch, end=date(2026, 5, 1), run_key="four")
    four = jobs(spark) - began - one
    assert four <= 4 * 25 and (four - one) / 3 <= 25, (one, four)
    assert len(target(spark, zone)) == 8


def test_chunks_beyond_a_wave_and_a_fault_in_the_second(spark, zone, monkeypatch):
    monkeypatch.setattr(backfill, "WAVE", 2)

    def fetch(start, _end):
        log = spark.createDataFrame([("111", 1, 403 if start.month == 4 else 200, None)],
                                    schemas.FETCH_LOG)
        return pages(spark, (111, f"2026-{start.month:02}-05", 1.0)), log

    with pytest.raises(RuntimeError, match="refused by the vendor, first: 111"):
        run(spark, zone, fetch, end=date(2026, 6, 1))
    assert [t for _, t, _ in target(spark, zone)] == ["01-05", "02-05", "03-05"]


def test_each_chunk_judges_its_stations_apart(spark, zone):
    rows = [(111, "2026-01-05", None), (111, "2026-02-05", 1.0), (222, "2026-01-05", 2.0)]
    report = run(spark, zone, lambda *_: (pages(spark, *rows), None))
    assert (report["bundles_loaded"], report["adapter_failures"]) == (2, 1)
    assert target(spark, zone) == [("pvacd-111-dtw", "02-05", 3.28), ("pvacd-222-dtw", "01-05", 6.56)]


def test_imported_checkpoints_of_all_stations_are_known(spark, zone):
    """Earlier deployments listed every station in the key of an all-stations run."""
    month = "2026-{:02}-01T00:00:00+00:00_2026-{:02}-01T00:00:00+00:00_{}"
    keys = spark.createDataFrame([(month.format(1, 2, "111,222"),), (month.format(2, 3, "111"),)],
                                 "chunk_key string")
    place = zone.progress("raw_pvacd_backfill")
    progress.commit_state(spark, place, progress.chunk_rows(keys, "r"))
    fetch = lambda *_: (pages(spark, (111, "2026-01-05", 1.0), (111, "2026-02-05", 1.0)), None)
    report = run(spark, zone, fetch, requested=[])
    assert (report["chunks_processed"], report["chunks_skipped"]) == (1, 1)
    assert [t for _, t, _ in target(spark, zone)] == ["02-05"]


def test_pages_are_fetched_once(spark, zone):
    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def noted(page):
        read.add(1)
        return page

    def fetch(_start, _end):
        return pages(spark, (111, "2026-01-05", 1.0), (222, "2026-02-05", 2.0)).withColumn(
            "page", noted("page")), None

    run(spark, zone, fetch)
    assert read.value == 4  # two pages for each of two chunks
    assert [row[0] for row in target(spark, zone)] == ["pvacd-111-dtw", "pvacd-222-dtw"]
