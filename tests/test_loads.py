import pathlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.operators import entities, watermarks, windows
from stillwell.plans import daily
from stillwell.plans.daily import load_batch, recovered_watermarks, run_daily
from stillwell.plans.replay import run_replay
from stillwell.sinks import state as progress
from stillwell.sinks.entities import read_entity, upsert_entities
from stillwell.sinks.observations import (
    months_of, read_observations, replace_window_in_place, sweep, write_batch,
)
from stillwell.sinks.raw import append_load, loads_meeting, replace_stations
from stillwell.sinks.zone import Zone
from stillwell.sources.specs import CITY_WELLS, LOGGERS
from stillwell.streaming import incremental
from stillwell.streaming.incremental import run_stream

JAN, FEB, MAR = (datetime(2026, m, 1, tzinfo=timezone.utc) for m in (1, 2, 3))


def seconds(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def raw(spark, *rows):
    return spark.createDataFrame(
        [(f"{l}_4_{t}", l, t, "4", "35", v) for l, t, v in rows], schemas.LOGGER_READINGS)


def marks(spark, *rows):
    return spark.createDataFrame([(k, datetime.fromisoformat(t)) for k, t in rows],
                                 "datastream_key string, watermark timestamp")


def obs(spark, *rows):
    return spark.createDataFrame(
        [(k, None if t is None else datetime.fromisoformat(t), v, None, None)
         for k, t, v in rows], schemas.OBSERVATION)


def target(spark, zone):
    rows = read_observations(spark, zone.observations).collect()
    return sorted((r["datastream_key"], r["phenomenon_time"].isoformat(" "), r["result"])
                  for r in rows)


@pytest.fixture
def loggers(spark, zone):
    table = spark.createDataFrame([(1, "one", "d", 1.0, 2.0), (2, "two", "d", 1.0, 2.0)],
                                  schemas.LOGGER_STATIONS)
    replace_stations(table, zone.stations(LOGGERS))
    return zone


# --- watermarks ------------------------------------------------------------------------
def test_a_row_at_the_watermark_is_skipped(spark):
    rows = obs(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-02", 2.0), ("b", "2026-01-01", 3.0))
    kept = watermarks.past_watermark(rows, marks(spark, ("a", "2026-01-01")))
    assert {(r["datastream_key"], r["result"]) for r in kept.collect()} == {("a", 2.0), ("b", 3.0)}


def test_repeats_inside_one_batch_all_pass(spark):
    rows = obs(spark, ("a", "2026-01-02", 1.0), ("a", "2026-01-02", 1.0))
    assert watermarks.past_watermark(rows, marks(spark, ("a", "2026-01-01"))).count() == 2


def test_the_target_answers_only_for_keys_without_a_mark(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "datastream_key string")
    held = obs(spark, ("a", "2026-05-01", 1.0), ("b", "2026-03-01", 1.0), ("z", "2026-04-01", 1.0))
    got = watermarks.effective_watermarks(
        keys, marks(spark, ("a", "2026-01-01")), lambda: watermarks.newest_per_datastream(held))
    assert {r["datastream_key"]: r["watermark"].month for r in got.collect()} == {"a": 1, "b": 3}


def test_load_results(spark):
    rows = obs(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-03", 2.0), ("b", "2026-01-01", 3.0))
    marked = watermarks.with_watermark(
        rows, marks(spark, ("a", "2026-01-02"), ("b", "2026-06-01")))
    got = {r["datastream_key"]: r for r in watermarks.load_results(marked).collect()}
    assert (got["a"]["considered"], got["a"]["posted"], got["a"]["skipped"]) == (2, 1, 1)
    assert got["a"]["new_watermark"].day == 3
    assert (got["b"]["posted"], got["b"]["new_watermark"].month) == (0, 6)


# --- daily job -------------------------------------------------------------------------
def test_daily_job_loads_once(spark, loggers):
    append_load(raw(spark, (1, 10, 1.0), (2, 20, 1.0)), loggers.raw(LOGGERS), 100.5)
    first = run_daily(spark, LOGGERS, loggers)
    assert (first["bundles_loaded"], first["observations_posted"]) == (2, 2)
    assert first["watermark_after"] == 100.5
    again = run_daily(spark, LOGGERS, loggers)
    assert again["rows_read"] == 0 and again["observations_posted"] == 0
    append_load(raw(spark, (1, 10, 1.0), (1, 11, 1.0)), loggers.raw(LOGGERS), 200.5)
    third = run_daily(spark, LOGGERS, loggers)
    assert (third["observations_posted"], third["observations_skipped"]) == (1, 1)
    assert len(target(spark, loggers)) == 3


def test_loads_without_depth_rows_still_advance(spark, loggers):
    other = raw(spark, (1, 10, 1.0)).withColumn("parameter_id", F.lit("33"))
    append_load(other, loggers.raw(LOGGERS), 100.5)
    report = run_daily(spark, LOGGERS, loggers)
    assert report["rows_read"] == 0 and report["watermark_after"] == 100.5
    state = progress.read_state(spark, loggers.progress("raw_pvacd"))
    assert progress.last_load(state, "raw_pvacd") == 100.5


def test_a_failing_station_is_quarantined_and_the_load_still_commits(spark, loggers):
    append_load(raw(spark, (1, 10, 1.0), (1, 11, None), (2, 20, 1.0)), loggers.raw(LOGGERS), 100.5)
    report = run_daily(spark, LOGGERS, loggers)
    assert report["adapter_failures"] == 1 and report["bundles_produced"] == 1
    assert [r["location_id"] for r in report["quarantined"].collect()] == [1]
    assert [k for k, _, _ in target(spark, loggers)] == ["pvacd-2-dtw"]


def test_an_attempt_that_failed_before_its_commit_is_replaced(spark, loggers, monkeypatch):
    append_load(raw(spark, (1, 10, 1.0), (2, 5000000, 1.0)), loggers.raw(LOGGERS), 100.5)

    commit = progress.commit_state

    def crash(spark, root, new, note, **more):
        if note == "origin":
            return commit(spark, root, new, note, **more)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily.progress, "commit_state", crash)
        with pytest.raises(OSError):
            run_daily(spark, LOGGERS, loggers)
    assert len(target(spark, loggers)) == 2
    # Meanwhile another load arrives, in which station 2 has a bad reading.
    append_load(raw(spark, (1, 12, 1.0), (2, 21, None)), loggers.raw(LOGGERS), 200.5)
    run_daily(spark, LOGGERS, loggers)
    assert [(k, t[-8:]) for k, t, _ in target(spark, loggers)] == [
        ("pvacd-1-dtw", "00:00:10"), ("pvacd-1-dtw", "00:00:12")]


def test_a_lost_watermark_is_recovered_from_the_target(spark, loggers):
    write_batch(obs(spark, ("pvacd-1-dtw", "1970-01-01 00:00:15", 1.0)), loggers.observations,
                "PVACD", "old")
    append_load(raw(spark, (1, 15, 1.0)), loggers.raw(LOGGERS), 100.5)
    report = run_daily(spark, LOGGERS, loggers)
    assert report["observations_skipped"] == 1
    assert report["results"].first()["new_watermark"].second == 15
    state = progress.read_state(spark, loggers.progress("raw_pvacd"))
    assert progress.watermarks(state, "raw_pvacd").count() == 0
    assert recovered_watermarks(spark, loggers).count() == 1


def test_entities_are_inserted_once_and_never_changed(spark, loggers):
    append_load(raw(spark, (1, 10, 1.0)), loggers.raw(LOGGERS), 100.5)
    run_daily(spark, LOGGERS, loggers)
    renamed = spark.createDataFrame([(1, "renamed", "d", 1.0, 2.0)], schemas.LOGGER_STATIONS)
    replace_stations(renamed, loggers.stations(LOGGERS))
    append_load(raw(spark, (1, 11, 1.0), (7, 11, 1.0)), loggers.raw(LOGGERS), 200.5)
    run_daily(spark, LOGGERS, loggers)
    names = {r["external_key"]: r["name"] for r in read_entity(spark, loggers, "location").collect()}
    assert names == {"pvacd-1": "one", "pvacd-7": ""}
    assert read_entity(spark, loggers, "sensor").count() == 1
    assert read_entity(spark, loggers, "datastream").count() == 2


def test_upsert_reports_what_it_added(spark, zone):
    table = spark.createDataFrame([("k", "n", "d", None, None)], schemas.THING)
    twice = table.unionByName(table)
    assert upsert_entities(spark, zone, {"thing": twice}) == {"thing": 1}
    assert upsert_entities(spark, zone, {"thing": twice}) == {"thing": 0}


def test_city_job(spark, zone):
    rows = spark.createDataFrame(
        [("A_1", "A", None, 1.0, 2.0, 1391079600000, None),
         ("A_2", "A", "x", 1.0, 2.0, 1391079600500, 5.0)], schemas.CITY_READINGS)
    append_load(rows.coalesce(1), zone.raw(CITY_WELLS), 100.5)
    report = run_daily(spark, CITY_WELLS, zone)
    assert report["observations_posted"] == 2
    assert read_entity(spark, zone, "location").first()["name"] == "A"
    assert [r for _, _, r in target(spark, zone) if r is None] == [None]


# --- stream ----------------------------------------------------------------------------
def test_stream_takes_each_file_once(spark, loggers, tmp_path):
    checkpoint = str(tmp_path / "cp")
    append_load(raw(spark, (1, 10, 1.0)), loggers.raw(LOGGERS), 100.5)
    assert run_stream(spark, LOGGERS, loggers, checkpoint)[0]["observations_posted"] == 1
    assert run_stream(spark, LOGGERS, loggers, checkpoint) == []
    append_load(raw(spark, (1, 9, 1.0), (1, 11, 1.0)), loggers.raw(LOGGERS), 200.5)
    report, = run_stream(spark, LOGGERS, loggers, checkpoint)
    assert (report["observations_posted"], report["observations_skipped"]) == (1, 1)


def test_a_lost_stream_checkpoint_offers_old_files_again_but_loads_only_new_rows(
    spark, loggers, tmp_path
):
    append_load(raw(spark, (1, 10, 1.0)), loggers.raw(LOGGERS), 100.5)
    run_stream(spark, LOGGERS, loggers, str(tmp_path / "cp"))
    append_load(raw(spark, (1, 11, 1.0)), loggers.raw(LOGGERS), 200.5)
    report, = run_stream(spark, LOGGERS, loggers, str(tmp_path / "other"))
    assert (report["observations_posted"], report["observations_skipped"]) == (1, 1)
    assert len(target(spark, loggers)) == 2


def test_a_stream_batch_committed_before_its_checkpoint_is_skipped(
    spark, loggers, tmp_path, monkeypatch
):
    append_load(raw(spark, (1, 10, 1.0)), loggers.raw(LOGGERS), 100.5)

    def crash_after(*args, **kwargs):
        load_batch(*args, **kwargs)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "load_batch", crash_after)
        with pytest.raises(Exception, match="lost"):
            run_stream(spark, LOGGERS, loggers, str(tmp_path / "cp"))
    assert run_stream(spark, LOGGERS, loggers, str(tmp_path / "cp")) == []
    assert len(target(spark, loggers)) == 1


def test_lost_progress_does_not_lose_or_double_rows(spark, loggers):
    for load_id, second in ((100.5, 10), (200.5, 20)):
        append_load(raw(spark, (1, second, 1.0)), loggers.raw(LOGGERS), load_id)
        run_daily(spark, LOGGERS, loggers)
    fresh = Elsewhere(loggers.root)
    report = run_daily(spark, LOGGERS, fresh)
    assert report["observations_skipped"] == 2
    assert len(target(spark, loggers)) == 2


class Elsewhere(Zone):
    """The same zone with its progress gone."""

    def progress(self, scope):
        return f"{self.root}/new-progress/{scope}"


# --- window replace --------------------------------------------------------------------
def stored(spark, zone):
    write_batch(obs(spark, ("a", "2026-01-05", 1.0), ("a", "2026-01-31 23:59:59", 2.0),
                    ("a", "2026-02-01", 3.0), ("b", "2026-01-05", 4.0)),
                zone.observations, "X", "one")
    write_batch(obs(spark, ("a", "2026-01-06", 5.0)), zone.observations, "X", "two")


def replace(spark, zone, new, start=JAN, end=FEB, known=(), batch="w", **more):
    return replace_window_in_place(spark, zone.observations, "X", batch, new, start, end,
                                   marks(spark, *known), **more)


def test_window_is_replaced_for_the_datastreams_given(spark, zone):
    stored(spark, zone)
    new = obs(spark, ("a", "2026-01-10", 10.0), ("a", "2026-01-01", 11.0))
    got = replace(spark, zone, new).first()
    assert (got["posted"], got["deleted"]) == (2, 3)
    assert target(spark, zone) == [
        ("a", "2026-01-01 00:00:00", 11.0), ("a", "2026-01-10 00:00:00", 10.0),
        ("a", "2026-02-01 00:00:00", 3.0), ("b", "2026-01-05 00:00:00", 4.0)]


def test_replacing_twice_changes_nothing(spark, zone):
    stored(spark, zone)
    for _ in range(2):
        replace(spark, zone, obs(spark, ("a", "2026-01-10", 10.0)))
    replace(spark, zone, obs(spark, ("b", "2026-01-11", 12.0)))
    assert [v for _, _, v in target(spark, zone)] == [10.0, 3.0, 12.0]


def test_partial_window_keeps_the_rest_of_its_month(spark, zone):
    stored(spark, zone)
    start, end = JAN.replace(day=5), JAN.replace(day=6)
    replace(spark, zone, obs(spark, ("a", "2026-01-05 12:00:00", 9.0)), start, end)
    assert [v for k, _, v in target(spark, zone) if k == "a"] == [9.0, 5.0, 2.0, 3.0]


def test_a_window_over_several_months(spark, zone):
    stored(spark, zone)
    replace(spark, zone, obs(spark, ("a", "2026-02-02", 9.0)), JAN, MAR)
    assert [v for k, _, v in target(spark, zone) if k == "a"] == [9.0]


def test_named_datastreams_are_cleared_without_new_rows(spark, zone):
    stored(spark, zone)
    keys = spark.createDataFrame([("a",)], "datastream_key string")
    got = replace(spark, zone, obs(spark), known=[("a", "2026-06-01")], keys=keys).first()
    assert (got["posted"], got["deleted"], got["new_watermark"].month) == (0, 3, 6)
    assert [v for k, _, v in target(spark, zone) if k == "a"] == [3.0]


def test_watermark_moves_forward_only(spark, zone):
    new = obs(spark, ("a", "2026-01-10", 1.0), ("b", "2026-01-10", 1.0), ("c", "2026-01-10", 1.0))
    got = replace(spark, zone, new, known=[("a", "2026-06-01"), ("b", "2025-12-01")])
    days = {r["datastream_key"]: r["new_watermark"].month for r in got.collect()}
    assert days == {"a": 6, "b": 1, "c": 1}


@pytest.mark.parametrize("time", ["2026-02-05", "2026-02-01", "2025-12-31 23:59:59"])
def test_a_record_outside_stops_everything(spark, zone, time):
    stored(spark, zone)
    before = target(spark, zone)
    with pytest.raises(ValueError):
        replace(spark, zone, obs(spark, ("a", "2026-01-10", 1.0), ("a", time, 1.0)))
    assert target(spark, zone) == before


def test_the_start_is_inside(spark, zone):
    replace(spark, zone, obs(spark, ("a", "2026-01-01", 1.0)))
    assert len(target(spark, zone)) == 1


def test_one_unacceptable_record_fails_the_whole_batch(spark, zone):
    bad = obs(spark, ("a", "2026-01-01", 1.0), (None, "2026-01-02", 1.0))
    assert windows.rejected(bad).count() == 1
    with pytest.raises(Exception, match="batch not written"):
        write_batch(bad, zone.observations, "X", "one")
    assert target(spark, zone) == []


def test_many_keys_give_the_same_survivors(spark):
    rows = obs(spark, ("a", "2026-01-05", 1.0), ("a", "2026-02-05", 2.0), ("b", "2026-01-05", 3.0))
    keys = spark.createDataFrame([("a",)], "datastream_key string")
    ways = [windows.kept_by(rows, keys, JAN, FEB, small=small) for small in (True, False)]
    assert [sorted(r["result"] for r in way.collect()) for way in ways] == [[2.0, 3.0]] * 2


def test_months_of_a_window():
    assert months_of(JAN, FEB) == ["2026-01"]
    assert months_of(datetime(2025, 12, 15), datetime(2026, 2, 1, 0, 0, 1)) == [
        "2025-12", "2026-01", "2026-02"]


def test_replay_maps_stored_raw_rows_again(spark, loggers):
    start = seconds("2026-01-05")
    append_load(raw(spark, (1, start, 1.0)), loggers.raw(LOGGERS), 100.5)
    run_daily(spark, LOGGERS, loggers)
    # The vendor corrects the value: the later arrival of the same reading wins.
    append_load(raw(spark, (1, start, 2.0), (1, seconds("2026-02-05"), 9.0)),
                loggers.raw(LOGGERS), 200.5)
    run_replay(spark, LOGGERS, loggers, JAN, FEB, run_key="fix")
    assert [round(v, 4) for _, _, v in target(spark, loggers)] == [6.5617]


# --- reading back ----------------------------------------------------------------------
def test_expanded_read(spark, loggers):
    append_load(raw(spark, (1, 10, 1.0)), loggers.raw(LOGGERS), 100.5)
    run_daily(spark, LOGGERS, loggers)
    t = {n: read_entity(spark, loggers, n) for n in schemas.ENTITIES}
    lonely = t["thing"].limit(1).withColumn("external_key", F.lit("pvacd-99"))
    flat = entities.expanded(t["thing"].unionByName(lonely), t["location"], t["datastream"],
                             t["sensor"], t["observed_property"])
    got = {r["thing_key"]: r["datastreams"] for r in entities.nested(flat).collect()}
    assert got["pvacd-1"][0]["sensor_name"] == "VuLink" and got["pvacd-99"] == []
    linked = entities.linked_datastreams(t["datastream"], t["thing"], t["sensor"],
                                         t["observed_property"])
    assert linked.first()["location_key"] == "pvacd-1"
    assert entities.observation_count(
        read_observations(spark, loggers.observations)).first()[0] == 1


def test_a_batch_can_be_loaded_directly(spark, loggers):
    rows = raw(spark, (1, 10, 1.0)).withColumns(
        {"load_id": F.lit(1.5), "file": F.lit("f"), "row": F.lit(0).cast("bigint")})
    report = load_batch(spark, LOGGERS, loggers, rows, batch="b", scope="s")
    assert report["observations_posted"] == 1


@pytest.mark.parametrize("step, at", [("_add", 1), ("_counted", 1), ("kept_by", 1), ("_add", 2),
                                      ("_counted", 2), ("commit_state", 1)])
def test_a_replace_that_stops_at_any_point_changes_nothing(spark, zone, monkeypatch, step, at):
    from stillwell.sinks import observations

    stored(spark, zone)
    before = target(spark, zone)
    new = obs(spark, ("a", "2026-01-05", 9.0), ("a", "2026-01-31 23:59:59", 8.0))
    real, calls = getattr(observations, step), []

    def stops(*args, **more):
        calls.append(1)
        if len(calls) == at:
            raise RuntimeError("lost")
        return real(*args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(observations, step, stops)
        with pytest.raises(RuntimeError, match="lost"):
            replace(spark, zone, new)
    assert target(spark, zone) == before
    replace(spark, zone, new)
    assert [v for _, _, v in target(spark, zone)] == [9.0, 8.0, 3.0, 4.0]


def test_readers_between_write_and_commit_see_the_old_rows(spark, zone, monkeypatch):
    from stillwell.sinks import observations

    stored(spark, zone)
    before, real = target(spark, zone), observations._commit
    seen = []

    def looks(*args):
        seen.append(target(spark, zone))
        real(*args)

    monkeypatch.setattr(observations, "_commit", looks)
    replace(spark, zone, obs(spark, ("a", "2026-01-10", 10.0)))
    assert seen == [before]
    assert [v for _, _, v in target(spark, zone)] == [10.0, 3.0, 4.0]


def test_a_new_station_opens_no_old_month(spark, loggers):
    write_batch(obs(spark, ("pvacd-1-dtw", "2020-01-01 00:00:15", 1.0),
                    ("pvacd-2-dtw", "2020-02-01 00:00:15", 1.0)), loggers.observations, "PVACD", "old")
    for part in broken(loggers.observations):
        part.write_bytes(b"no parquet")
    start = seconds("2020-01-01")
    append_load(raw(spark, (1, start + 15, 1.0), (1, start + 16, 1.0), (7, start, 1.0)),
                loggers.raw(LOGGERS), 100.5)
    report = run_daily(spark, LOGGERS, loggers)
    assert (report["observations_posted"], report["observations_skipped"]) == (2, 1)
    assert recovered_watermarks(spark, loggers).count() == 3


def broken(root):
    found = list(pathlib.Path(root).rglob("part-*.parquet"))
    assert found
    return found


def test_a_foreign_folder_is_neither_listed_nor_opened(spark, zone):
    stored(spark, zone)
    # Of another agency, another month, and of an attempt that never committed.
    write_batch(obs(spark, ("z", "2026-01-05", 1.0)), zone.observations, "Y", "one")
    write_batch(obs(spark, ("a", "2025-05-05", 1.0)), zone.observations, "X", "may")
    for part in broken(f"{zone.observations}/agency=Y"):
        part.write_bytes(b"no parquet")
    may = [p for p in broken(f"{zone.observations}/agency=X") if "obs_month=2025-05" in str(p)]
    for part in may:
        part.write_bytes(b"no parquet")
    stray = pathlib.Path(zone.observations) / "agency=X/generation=2/obs_month=2026-01/batch=s"
    stray.mkdir(parents=True)
    (stray / "part-0.parquet").write_bytes(b"no parquet")
    got = replace(spark, zone, obs(spark, ("a", "2026-01-10", 10.0))).first()
    assert (got["posted"], got["deleted"]) == (1, 3)
    held = read_observations(spark, zone.observations, "X", ["2026-01", "2026-02"]).collect()
    assert sorted(r["result"] for r in held) == [3.0, 4.0, 10.0]


def test_swept_folders_are_those_that_are_not_live(spark, zone):
    stored(spark, zone)
    replace(spark, zone, obs(spark, ("a", "2026-01-10", 10.0)))
    before = target(spark, zone)
    assert sweep(spark, zone.observations, "X", datetime(2020, 1, 1, tzinfo=timezone.utc)) == 0
    assert sweep(spark, zone.observations, "X", datetime(2100, 1, 1, tzinfo=timezone.utc)) == 2
    assert target(spark, zone) == before
    assert sweep(spark, zone.observations, "X", datetime(2100, 1, 1, tzinfo=timezone.utc)) == 0


def test_batches_with_odd_names_can_be_read(spark, zone):
    write_batch(obs(spark, ("a", "2026-01-05", 1.0)), zone.observations, "X", "a/b=c %{d}")
    got = replace(spark, zone, obs(spark, ("b", "2026-01-10", 2.0)), batch="e*:f").first()
    assert got["posted"] == 1
    assert {(r["batch"], r["result"]) for r in read_observations(spark, zone.observations).collect()
            } == {("a/b=c %{d}", 1.0), ("e*:f", 2.0)}


# --- replay by event times, streams by bounded batches ---------------------------------
def test_replay_opens_only_loads_that_meet_the_window(spark, loggers):
    root = loggers.raw(LOGGERS)
    old, start = seconds("2020-01-05"), seconds("2026-01-05")
    append_load(raw(spark, (1, old, 1.0)), root, 50.5)
    append_load(raw(spark, (1, start, 1.0), (2, start, 5.0)), root, 100.5)
    append_load(raw(spark, (1, start, 2.0), (1, seconds("2026-02-05"), 9.0)), root, 200.5)
    for part in broken(f"{root}/year=1970/month=01/day=01/load_id=50.500000"):
        part.write_bytes(b"no parquet")
    assert len(loads_meeting(spark, root, seconds("2026-01-01"), seconds("2026-02-01"))) == 2
    run_replay(spark, LOGGERS, loggers, JAN, FEB, run_key="fix")
    assert [(k, round(v, 4)) for k, _, v in target(spark, loggers)] == [
        ("pvacd-1-dtw", 6.5617), ("pvacd-2-dtw", 16.4042)]


def test_loads_without_bounds_are_opened(spark, loggers):
    root, start = loggers.raw(LOGGERS), seconds("2026-01-05")
    raw(spark, (1, start, 1.0)).write.parquet(f"{root}/year=2026/load_id=300.500000")
    assert len(loads_meeting(spark, root, 0, 1)) == 1
    run_replay(spark, LOGGERS, loggers, JAN, FEB, run_key="fix")
    assert len(target(spark, loggers)) == 1


def test_a_reading_without_a_time_fails_its_station_in_a_replay_too(spark, loggers):
    start = seconds("2026-01-05")
    append_load(raw(spark, (1, start, 1.0), (1, None, 1.0), (2, start, 1.0)),
                loggers.raw(LOGGERS), 100.5)
    run_replay(spark, LOGGERS, loggers, JAN, FEB, run_key="fix")
    assert [k for k, _, _ in target(spark, loggers)] == ["pvacd-2-dtw"]


def test_a_load_written_again_widens_its_bounds(spark, loggers):
    root = loggers.raw(LOGGERS)
    for t in (100, 900):
        append_load(raw(spark, (1, t, 1.0)), root, 100.5)
    assert [len(loads_meeting(spark, root, *w)) for w in ((0, 100), (100, 101), (900, 901), (901, 999))
            ] == [0, 1, 1, 0]


def test_a_stream_in_small_batches_loads_the_same(spark, tmp_path):
    tables = []
    for name, bounds in (("whole", {}), ("one", {"max_files": 1}), ("bytes", {"max_bytes": 1})):
        zone = Zone(str(tmp_path / name))
        replace_stations(spark.createDataFrame([(1, "one", "d", 1.0, 2.0)], schemas.LOGGER_STATIONS),
                         zone.stations(LOGGERS))
        for n in range(3):
            append_load(raw(spark, (1, 10 + n, float(n)), (2, 20 + n, 1.0)).coalesce(1),
                        zone.raw(LOGGERS), 100.5 + n)
        reports = run_stream(spark, LOGGERS, zone, str(tmp_path / f"{name}-cp"), **bounds)
        assert len(reports) == (3 if bounds else 1)
        assert sum(r["observations_posted"] for r in reports) == 6
        tables.append(target(spark, zone))
    assert tables[0] == tables[1] == tables[2] and len(tables[0]) == 6


def test_jobs_of_a_daily_run(spark, loggers):
    def jobs():
        return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()

    counts = []
    for load_id, second in ((100.5, 10), (200.5, 20)):
        append_load(raw(spark, (1, second, 1.0), (2, second, 1.0)), loggers.raw(LOGGERS), load_id)
        began = jobs()
        run_daily(spark, LOGGERS, loggers)
        counts.append(jobs() - began)
    assert counts[0] <= 50 and counts[1] <= 35, counts
