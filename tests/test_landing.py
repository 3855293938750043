import json

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.operators.audit import (
    advanced_cursors, fetch_outcomes, ingest_stats, require_no_fatal, require_some_success,
)
from stillwell.operators.filters import cut_pages, from_cursor, only_stations, within
from stillwell.plans.ingest import run_city_ingest, run_ingest
from stillwell.sinks.state import cursors, read_state
from stillwell.sources import landing, scan
from stillwell.sources.specs import CITY_WELLS, LOGGERS


def payload(*readings, parameter="4", unit="35"):
    return {"parameters": [{"parameterId": parameter, "unitId": unit, "readings": [
        {"timestamp": t, "value": v} for t, v in readings]}]}


def pages(spark, tmp_path, *entries):
    path = tmp_path / "pages.json"
    path.write_text("\n".join(
        json.dumps({"location_id": l, "page": p, "payload": body}) for l, p, body in entries))
    return landing.read_reading_pages(spark, str(path))


def test_payload_becomes_flat_rows(spark, tmp_path):
    body = payload((1780704000, 42.5), (1780707600, 43.0), parameter="33", unit="241")
    got = landing.logger_readings(pages(spark, tmp_path, (4503618672918528, 1, body)))
    row = got.orderBy("timestamp").first()
    assert got.columns == schemas.LOGGER_READINGS.names and got.count() == 2
    assert row["reading_id"] == "4503618672918528_33_1780704000"
    assert row["location_id"] == 4503618672918528 and row["value"] == 42.5


def test_payload_files_take_station_and_page_from_their_folder(spark, tmp_path):
    folder = tmp_path / "p" / "location_id=7" / "page=2"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps(payload((5, 1.0)), indent=2))
    got = landing.flatten_pages(landing.read_payload_files(spark, str(tmp_path / "p"))).first()
    assert (got["location_id"], got["page"], got["timestamp"]) == (7, 2, 5)


def test_empty_payloads_give_no_rows(spark, tmp_path):
    got = landing.logger_readings(pages(spark, tmp_path, (1, 1, {"parameters": []}), (2, 1, {})))
    assert got.count() == 0


def test_allowlist(spark, tmp_path):
    landed = pages(spark, tmp_path, (1, 1, payload((5, 1.0))), (2, 1, payload((5, 1.0))))
    assert landing.logger_readings(landed, [1]).first()["location_id"] == 1
    assert landing.logger_readings(landed, []).count() == 0
    wide = list(range(2, 5000))
    assert only_stations(landed, wide).count() == 1
    assert only_stations(landed, spark.createDataFrame([(2,), (2,)], "id long")).count() == 1


def test_window_stops_at_the_page_that_reaches_its_end(spark, tmp_path):
    landed = pages(spark, tmp_path, (1, 1, payload((100, 1.0), (250, 2.0))),
                   (1, 2, payload((150, 3.0), (400, 3.0))), (2, 1, payload((100, 1.0), (300, 1.0))))
    got = landing.window_readings(landed, [1, 2], 0, 200)
    assert {(r["location_id"], r["timestamp"]) for r in got.collect()} == {(1, 100), (2, 100)}


def test_window_is_half_open(spark, tmp_path):
    landed = pages(spark, tmp_path, (1, 1, payload((99, 0.0), (100, 1.0), (199, 1.0), (200, 2.0))))
    got = landing.window_readings(landed, [1], 100, 200)
    assert sorted(r["timestamp"] for r in got.collect()) == [100, 199]
    assert within(got, 100, 101).count() == 1


def test_cut_is_per_station(spark):
    rows = spark.createDataFrame([(1, 1, 250), (1, 2, 100), (2, 2, 100)],
                                 "location_id long, page long, timestamp long")
    got = {(r["location_id"], r["page"]) for r in cut_pages(rows, 200).collect()}
    assert got == {(2, 2)}


def test_pages_merge_in_page_order(spark, tmp_path):
    landed = pages(spark, tmp_path, (1, 2, payload((3, 3.0))), (1, 1, payload((2, 2.0), (1, 1.0))))
    got = landing.merge_pages(landed).orderBy("page", "slot", "slot_position").collect()
    assert [r["timestamp"] for r in got] == [2, 1, 3]


def test_station_list(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text(json.dumps([{"id": 4503618672918528, "name": "Bartlett-827276",
                                 "description": "827276",
                                 "gps": {"latitude": 35.1, "longitude": -106.5}}]))
    row = landing.flatten_stations(landing.read_stations(spark, str(path))).first()
    assert tuple(row) == (4503618672918528, "Bartlett-827276", "827276", 35.1, -106.5)


def features(spark, tmp_path, name, *rows):
    path = tmp_path / name
    path.write_text(json.dumps({"features": [{"attributes": r} for r in rows]}))
    return landing.read_features(spark, str(path))


def test_city_features(spark, tmp_path):
    place = {"sys_loc_code": "IW4", "loc_name": "WELL 4", "latitude": -106.6, "longitude": 35.2}
    read = {"sys_loc_code": "IW4", "measurement_date": 1391079600000, "water_depth": 162.396}
    stations = landing.distinct_stations(
        landing.attributes(features(spark, tmp_path, "s.json", place, place)))
    assert stations.count() == 1
    rows = landing.city_readings(
        landing.attributes(features(spark, tmp_path, "r.json", read)), stations)
    assert rows.columns == schemas.CITY_READINGS.names
    assert tuple(rows.first()) == ("IW4_1391079600000", "IW4", "WELL 4", -106.6, 35.2,
                                   1391079600000, 162.396)


def test_a_code_with_two_names_is_read_twice(spark):
    stations = spark.createDataFrame([("A", "one", 1.0, 2.0), ("A", "two", 1.0, 2.0)],
                                     "sys_loc_code string, loc_name string, latitude double, "
                                     "longitude double")
    reads = spark.createDataFrame([("A", 5, 1.0)], "sys_loc_code string, measurement_date long, "
                                                   "water_depth double")
    assert landing.city_readings(reads, stations).count() == 2


def test_name_table(spark, tmp_path):
    path = tmp_path / "names.json"
    path.write_text(json.dumps({"parameters": {"4": "Level: Depth to Water"},
                                "units": {"35": "m"}}))
    names = landing.read_name_table(spark, str(path))
    assert {tuple(r) for r in names.collect()} == {
        ("parameter", "4", "Level: Depth to Water"), ("unit", "35", "m")}
    rows = spark.createDataFrame([("4",), ("9",)], "parameter_id string")
    got = {r[0]: r[1] for r in landing.with_names(rows, names).collect()}
    assert got == {"4": "Level: Depth to Water", "9": None}


# --- cursors and statistics ------------------------------------------------------------
def test_cursor_floor(spark):
    rows = spark.createDataFrame([(1, 5), (1, 10), (2, 5), (2, 7)],
                                 "location_id long, timestamp long")
    marks = spark.createDataFrame([(1, 10)], "location_id long, cursor long")
    got = {tuple(r) for r in from_cursor(rows, marks, 6).collect()}
    assert got == {(1, 10), (2, 7)}


def test_city_floor_is_the_day_of_the_cursor(spark):
    rows = spark.createDataFrame([("A", 86400), ("A", 86399)], "location_id string, timestamp long")
    marks = spark.createDataFrame([("A", 100000)], "location_id string, cursor long")
    assert from_cursor(rows, marks, 0, by_day=True).first()["timestamp"] == 86400
    assert from_cursor(rows, marks, 0, by_day=True).count() == 1


def log(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.FETCH_LOG)


@pytest.mark.parametrize("status, error, expected", [
    (200, None, "ok"), (204, None, "ok"), (404, None, "no_data"), (429, None, "error"),
    (500, None, "error"), (503, None, "error"), (None, "timeout", "error"),
    (403, None, "fatal"), (302, None, "fatal"),
])
def test_fetch_outcome(spark, status, error, expected):
    assert fetch_outcomes(log(spark, ("1", 1, status, error))).first()["outcome"] == expected


def test_the_last_attempt_decides(spark):
    got = fetch_outcomes(log(spark, ("1", 1, 503, None), ("1", 2, 200, None)))
    assert [r["outcome"] for r in got.collect()] == ["ok"]


def test_ingest_fails_only_when_nothing_was_fetched(spark):
    one_good = fetch_outcomes(log(spark, ("1", 1, 503, None), ("2", 1, 200, None)))
    require_some_success(ingest_stats(one_good))
    all_bad = fetch_outcomes(log(spark, ("1", 1, 503, None), ("2", 1, 404, None)))
    with pytest.raises(RuntimeError):
        require_some_success(ingest_stats(all_bad))
    with pytest.raises(RuntimeError):
        require_no_fatal(fetch_outcomes(log(spark, ("1", 1, 401, None))))


def test_cursors_advance_for_fetched_stations_only(spark):
    rows = spark.createDataFrame([(1, 50), (1, 90), (2, 70)], "location_id long, timestamp long")
    fetched = spark.createDataFrame(
        [("1", "ok", 10), ("2", "error", 10), ("3", "ok", 20), ("4", "ok", None)],
        "location_id string, outcome string, cursor long")
    got = {r["location_id"]: r["cursor"] for r in advanced_cursors(rows, fetched, 5).collect()}
    assert got == {"1": 90, "3": 20, "4": 5}


def test_ingest_job(spark, tmp_path, zone):
    stations = spark.createDataFrame([(i, f"n{i}", "", (1.0, 2.0)) for i in (1, 2, 3, 4)],
                                     schemas.STATION_PAYLOAD)
    landed = pages(spark, tmp_path, (1, 1, payload((10, 1.0), (20, 1.0))),
                   (2, 1, payload((30, 1.0))), (3, 1, payload((40, 1.0))))
    report = run_ingest(
        spark, LOGGERS, zone, station_list=stations, pages=landed, allowed=[1, 2, 4], start_ts=5,
        log=log(spark, ("1", 1, 200, None), ("2", 1, 503, None), ("4", 1, 404, None)),
    )
    assert report["rows_yielded"] == 2 and report["locations_fetched"] == 1
    assert report["locations_skipped"] == 1 and report["locations_no_data"] == 1
    assert report["locations_errored"] == 1
    written = scan.scan_new(spark, zone.raw(LOGGERS), LOGGERS.schema)
    assert {r["location_id"] for r in written.collect()} == {1}
    assert scan.scan_stations(spark, zone.stations(LOGGERS), schemas.LOGGER_STATIONS).count() == 4
    state = read_state(spark, zone.progress(LOGGERS.dataset))
    assert [tuple(r) for r in cursors(state, LOGGERS.dataset).collect()] == [("1", 20)]


def test_city_ingest_job(spark, tmp_path, zone):
    places = features(spark, tmp_path, "s.json",
                      *[{"sys_loc_code": c, "loc_name": c, "latitude": 1.0, "longitude": 2.0}
                        for c in "ABC"])
    reads = features(spark, tmp_path, "r.json",
                     *[{"sys_loc_code": c, "measurement_date": t, "water_depth": 1.0}
                       for c, t in (("A", 86400_000), ("A", 86399_999), ("B", 90000_000))])
    logged = log(spark, ("A", 1, 200, None), ("B", 1, 500, None), ("C", 1, 404, None))
    args = dict(features=reads, station_features=places, log=logged, start_ts=86400)
    report = run_city_ingest(spark, CITY_WELLS, zone, **args)
    assert report["rows_yielded"] == 1 and report["locations_errored"] == 1
    state = read_state(spark, zone.progress(CITY_WELLS.dataset))
    assert [tuple(r) for r in cursors(state, CITY_WELLS.dataset).collect()] == [("A", 86400)]
    again = run_city_ingest(spark, CITY_WELLS, zone, **args)
    assert again["rows_yielded"] == 1
    rows = scan.scan_new(spark, zone.raw(CITY_WELLS), CITY_WELLS.schema)
    assert rows.count() == 2 and rows.agg(F.count_distinct("reading_id")).first()[0] == 1


def test_ids_take_the_type_of_the_column(spark):
    landed = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "location_id bigint, x string")
    for filler in (998, 999):  # 1000 and 1001 ids
        ids = ["1", "3"] + [f"no-{i}" for i in range(filler)]
        assert {r[0] for r in only_stations(landed, ids).collect()} == {1, 3}
    table = spark.createDataFrame([("1",), ("x",)], "id string")
    assert {r[0] for r in only_stations(landed, table).collect()} == {1}


def test_damaged_pages_are_counted_not_lost(spark, tmp_path):
    whole = '{"location_id": 1, "page": 0, "payload": {"parameters": []}}'
    path = tmp_path / "pages.json"
    path.write_text("\n".join([whole, whole.replace("1", "2", 1)[:-9], whole[:8]]) + "\n")
    pages = landing.read_reading_pages(spark, str(path))
    found = {r["location_id"]: r["pages"] for r in landing.damaged_pages(pages).collect()}
    assert found == {2: 1, None: 1}
    assert landing.flatten_pages(pages).count() == 0


def test_damaged_station_lists_are_refused(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text('{"id": 1, "name": "a"}\n{"id": 2, "na')
    with pytest.raises(Exception, match="damaged record"):
        landing.flatten_stations(landing.read_stations(spark, str(path), lines=True)).collect()


def test_readings_without_a_time_reach_the_quarantine(spark):
    pages = spark.createDataFrame(
        [(1, 0, ([("4", "35", None, [(100, 1.0), (None, 2.0), (900, 3.0)])],))],
        "location_id bigint, page bigint, payload struct<parameters: array<struct<parameterId: "
        "string, unitId: string, customParameter: boolean, "
        "readings: array<struct<timestamp: bigint, value: double>>>>>")
    got = landing.window_readings(pages, [1], 0, 200)
    assert sorted(str(r["timestamp"]) for r in got.collect()) == ["100", "None"]


def _ingest(spark, zone, landed, *entries):
    stations = spark.createDataFrame([(i, f"n{i}", "", (1.0, 2.0)) for i in (1, 2)],
                                     schemas.STATION_PAYLOAD)
    return run_ingest(spark, LOGGERS, zone, station_list=stations, pages=landed, allowed=[1, 2],
                      start_ts=5, log=log(spark, *entries))


def test_a_retried_ingest_replaces_its_load(spark, tmp_path, zone, monkeypatch):
    from stillwell.plans import ingest
    from stillwell.plans.daily import run_daily

    landed = pages(spark, tmp_path, (1, 1, payload((10, 1.0), (20, 2.0))))
    ok = ("1", 1, 200, None)
    real = ingest.progress.commit_state
    monkeypatch.setattr(ingest.progress, "commit_state", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _ingest(spark, zone, landed, ok)
    monkeypatch.setattr(ingest.progress, "commit_state", real)
    _ingest(spark, zone, landed, ok)
    assert scan.scan_new(spark, zone.raw(LOGGERS), LOGGERS.schema).count() == 2
    assert run_daily(spark, LOGGERS, zone)["observations_posted"] == 2
    again = _ingest(spark, zone, landed, ok)  # the cursor leaves out what is known
    assert again["rows_yielded"] == 1


def test_a_damaged_page_is_an_error_of_its_station(spark, tmp_path, zone):
    path = tmp_path / "pages.json"
    good = json.dumps({"location_id": 1, "page": 1, "payload": payload((10, 1.0))})
    path.write_text(good + "\n" + good.replace('"location_id": 1', '"location_id": 2')[:-5] + "\n")
    landed = landing.read_reading_pages(spark, str(path))
    report = _ingest(spark, zone, landed, ("1", 1, 200, None), ("2", 1, 200, None))
    assert report["locations_fetched"] == 1 and report["locations_errored"] == 1
    state = read_state(spark, zone.progress(LOGGERS.dataset))
    assert [r["location_id"] for r in cursors(state, LOGGERS.dataset).collect()] == ["1"]


def test_nothing_is_written_if_no_station_was_fetched(spark, tmp_path, zone):
    landed = pages(spark, tmp_path, (1, 1, payload((10, 1.0))))
    with pytest.raises(RuntimeError):
        _ingest(spark, zone, landed, ("1", 1, 503, None), ("2", 1, 503, None))
    assert scan.newest_load(spark, zone.raw(LOGGERS)) is None
    with pytest.raises(FileNotFoundError):
        scan.scan_stations(spark, zone.stations(LOGGERS), schemas.LOGGER_STATIONS)


def test_diver_payloads_are_read_from_lines(spark, tmp_path):
    wells, levels = tmp_path / "wells.json", tmp_path / "levels.json"
    wells.write_text(json.dumps({"uid": "w", "drillingDepth": 612.648, "numberOfScreens": 1}) + "\n")
    levels.write_text(json.dumps({
        "uid": "w", "approvedWaterLevelsGs": [{"ts": 1, "gs": 2.0}],
        "unApprovedWaterLevelsGs": [{"ts": 2, "gs": 3.0}]}) + "\n")
    assert landing.read_wells(spark, str(wells)).first()["drillingDepth"] == 612.648
    got = landing.flatten_levels(landing.read_levels(spark, str(levels))).collect()
    assert {(r["timestamp"], r["result_quality"]) for r in got} == {
        (1, "approved"), (2, "unapproved")}
    levels.write_text(levels.read_text() + '{"uid": "x", "appr\n')
    with pytest.raises(Exception, match="damaged record"):
        landing.flatten_levels(landing.read_levels(spark, str(levels))).collect()
