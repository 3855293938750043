from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.operators import mapping
from stillwell.operators.filters import swapped_coordinates, unexpected_unit
from stillwell.sources.landing import flatten_levels, observation_parameters
from stillwell.sources.specs import CITY_WELLS, DIVERS, LOGGERS, diver_stations

WELL = 4745648669458432


def logger(spark, *rows):
    """(location, parameter, unit, second, value) tuples as raw rows with arrival order."""
    full = [(f"{l}_{p}_{t}", l, t, p, u, v, 1.5, "f", i)
            for i, (l, p, u, t, v) in enumerate(rows)]
    return spark.createDataFrame(full, _arrived(schemas.LOGGER_READINGS))


def city(spark, *rows):
    """(location, name, lat, lon, millis, value) tuples."""
    full = [(f"{l}_{t}", l, n, la, lo, t, v, 1.5, "f", i)
            for i, (l, n, la, lo, t, v) in enumerate(rows)]
    return spark.createDataFrame(full, _arrived(schemas.CITY_READINGS))


def _arrived(schema):
    names = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
    return ", ".join([*names, "load_id double", "file string", "row bigint"])


def stations(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.LOGGER_STATIONS)


def mapped(spec, raw):
    flagged = spec.flagged(raw)
    outcomes = spec.outcomes(flagged)
    return outcomes, spec.observations(mapping.good_rows(flagged, outcomes))


def test_only_depth_rows_become_observations_in_feet(spark):
    raw = logger(spark, (WELL, "4", "35", 1780704000, 10.0), (WELL, "1", "1", 1780704000, 22.5),
                 (WELL, "33", "241", 1780704000, 54.0))
    _, obs = mapped(LOGGERS, raw)
    row, = obs.collect()
    assert row["datastream_key"] == f"pvacd-{WELL}-dtw"
    assert row["result"] == pytest.approx(32.8084)
    assert row["phenomenon_time"] == datetime(2026, 6, 6)
    assert row["parameters"] is None and row["result_quality"] is None


def test_other_parameters_alone_give_nothing(spark):
    outcomes, obs = mapped(LOGGERS, logger(spark, (WELL, "1", "1", 1780704000, 22.5)))
    assert outcomes.count() == 0 and obs.count() == 0


def test_one_bad_reading_fails_its_station_only(spark):
    raw = logger(spark, (1, "4", "35", 10, 1.0), (1, "4", "35", 20, None),
                 (2, "4", "35", 10, 1.0), (3, "4", "35", None, 1.0),
                 (4, "4", "35", 999999999999999, 1.0))
    outcomes, obs = mapped(LOGGERS, raw)
    failed = {r["location_id"]: r["failure"] for r in mapping.failed_stations(outcomes).collect()}
    assert failed == {1: "null value", 3: "null timestamp", 4: "timestamp out of range"}
    assert [r["datastream_key"] for r in obs.collect()] == ["pvacd-2-dtw"]


def test_a_bad_reading_of_another_parameter_is_harmless(spark):
    raw = logger(spark, (1, "4", "35", 10, 1.0), (1, "1", "1", 20, None))
    outcomes, obs = mapped(LOGGERS, raw)
    assert mapping.failed_stations(outcomes).count() == 0 and obs.count() == 1


def test_rows_without_a_station_count_as_one_failure(spark):
    raw = logger(spark, (None, "4", "35", 10, 1.0), (None, "4", "35", 20, 1.0),
                 (2, "4", "35", 10, 1.0))
    outcomes, obs = mapped(LOGGERS, raw)
    assert mapping.failed_stations(outcomes).count() == 1 and obs.count() == 1


def test_city_values_keep_their_unit_and_may_be_null(spark):
    raw = city(spark, ("IW4", "WELL 4", 35.1, -106.5, 1391079600000, 162.396),
               ("IW4", "WELL 4", 35.1, -106.5, 1391079600500, None))
    _, obs = mapped(CITY_WELLS, raw)
    got = {F_(r): r["result"] for r in obs.collect()}
    assert got == {"2014-01-30T11:00:00": 162.396, "2014-01-30T11:00:00.500000": None}
    assert {r["datastream_key"] for r in obs.collect()} == {"cabq-IW4-dtw"}


def F_(row):
    return row["phenomenon_time"].isoformat()


def test_city_null_time_quarantines_the_station(spark):
    raw = city(spark, ("A", "a", 1.0, 2.0, None, 1.0), ("B", "b", 1.0, 2.0, 1000, 1.0))
    outcomes, obs = mapped(CITY_WELLS, raw)
    assert mapping.failed_stations(outcomes).first()["location_id"] == "A"
    assert obs.count() == 1


def test_first_row_names_the_city_station(spark):
    raw = city(spark, ("A", None, 1.0, 2.0, 5000, 1.0), ("A", "late", 9.0, 9.0, 1000, 1.0),
               ("B", "first", None, 2.0, 5000, 1.0), ("B", "second", 9.0, 9.0, 1000, 1.0))
    outcomes = CITY_WELLS.outcomes(CITY_WELLS.flagged(raw))
    got = {r["location_id"]: r for r in CITY_WELLS.stations(outcomes, None).collect()}
    assert got["A"]["location_name"] == "A" and got["A"]["latitude"] == 1.0
    assert got["B"]["location_name"] == "first" and got["B"]["latitude"] is None
    again = {r["location_id"]: r["location_name"] for r in
             mapping.first_row_stations(raw, ["load_id", "file", "row"]).collect()}
    assert again == {"A": "A", "B": "first"}


def test_missing_station_gets_empty_texts_but_a_present_null_stays(spark):
    raw = logger(spark, (1, "4", "35", 10, 1.0), (2, "4", "35", 10, 1.0))
    table = stations(spark, (1, None, "d", 35.1, None))
    got = {r["location_id"]: r for r in mapping.stations_of(raw, table).collect()}
    assert got[1]["location_name"] is None and got[1]["location_description"] == "d"
    assert got[1]["longitude"] is None and got[1]["latitude"] == 35.1
    assert got[2]["location_name"] == "" and got[2]["location_description"] == ""
    assert got[2]["latitude"] is None


def test_logger_entities(spark):
    raw = logger(spark, (WELL, "4", "35", 10, 1.0))
    table = stations(spark, (WELL, "Bartlett Level Troll", "827276", 33.07, -104.375))
    tables = LOGGERS.entities(mapping.stations_of(raw, table))
    place, thing, stream = (tables[n].first() for n in ("location", "thing", "datastream"))
    assert place["external_key"] == thing["external_key"] == f"pvacd-{WELL}"
    assert place["name"] == "Bartlett Level Troll"
    assert place["geometry"]["coordinates"] == [-104.375, 33.07]
    assert place["properties"]["agency"] is None and thing["properties"]["agency"] == "PVACD"
    assert thing["properties"]["source_id"] == str(WELL)
    assert thing["properties"]["source_specific"] == {"hydrovu_description": "827276"}
    assert thing["properties"]["externalId"] == thing["external_key"]
    assert thing["location_key"] == place["external_key"]
    assert stream["external_key"] == f"pvacd-{WELL}-dtw"
    assert stream["unit_of_measurement"]["symbol"] == "ft"
    assert stream["sensor_key"] == tables["sensor"].first()["external_key"]
    for name, schema in schemas.ENTITIES.items():
        assert tables[name].columns == schema.names


def test_city_location_text_and_sensor(spark):
    raw = city(spark, ("IW4", "WELL 4", 35.1, -106.5, 1391079600000, 1.0))
    tables = CITY_WELLS.entities(
        CITY_WELLS.stations(CITY_WELLS.outcomes(CITY_WELLS.flagged(raw)), None)
    )
    assert tables["location"].first()["description"].endswith("measurements were collected")
    assert tables["location"].first()["properties"]["source_specific"] == {}
    assert tables["datastream"].first()["sensor_key"] == "sensor-manual-measurement"


def test_elevation_text_names_agency_and_thing(spark):
    raw = logger(spark, (1, "4", "35", 10, 1.0))
    thing = LOGGERS.entities(mapping.stations_of(raw, stations(spark)))["thing"]
    text = mapping.elevation_datastreams(thing, "pvacd", LOGGERS.sensor).first()["description"]
    assert text == "Water level elevation relative to NAVD88 — PVACD Water Well"


def test_bundles_page_observations_and_keep_things_without_any(spark):
    raw = logger(spark, *[(1, "4", "35", t, 1.0) for t in range(7)], (2, "4", "35", 5, None))
    outcomes, obs = mapped(LOGGERS, raw)
    streams = LOGGERS.entities(mapping.stations_of(raw, stations(spark)))["datastream"]
    pages = mapping.bundles(streams, obs, ["phenomenon_time", "result"], size=3)
    got = {(r["thing_key"], r["page"]): r["observations"] for r in pages.collect()}
    assert [len(got[("pvacd-1", p)]["pvacd-1-dtw"]) for p in range(3)] == [3, 3, 1]
    assert got[("pvacd-2", 0)] == {}


def test_flags(spark):
    raw = logger(spark, (1, "4", "35", 1, 1.0), (1, "4", "1", 2, 1.0), (1, "4", None, 3, 1.0))
    assert raw.where(unexpected_unit()).count() == 2
    places = spark.createDataFrame([(-106.6,), (35.1,)], "latitude double")
    assert places.where(swapped_coordinates()).count() == 1


def test_diver_wells(spark):
    wells = spark.createDataFrame(
        [("sanacaciareach-39", "BRN E-01-A", 34.0, -106.8, True, "MonitoringWell", 612.648, 1,
          "2024-10-30T07:00:00", [(39, "SO-0125", True)])], schemas.WELL_PAYLOAD)
    tables = DIVERS.entities(diver_stations(wells))
    thing, place = tables["thing"].first(), tables["location"].first()
    assert thing["external_key"] == "sanacaciareach-39"
    assert thing["properties"]["agency"] == "SanAcaciaReach"
    facts = thing["properties"]["source_specific"]
    assert float(facts["well_depth_ft"]) == pytest.approx(20.1)
    assert facts["monitoring_point_names"] == '["SO-0125"]'
    assert facts["number_of_screens"] == "1"
    assert place["properties"]["source_specific"] == {}
    assert tables["datastream"].first()["external_key"] == "sanacaciareach-39-dtw"


def test_diver_levels_take_their_quality_from_their_array(spark):
    levels = spark.createDataFrame(
        [("w-1", [(1, 2.0)], [(2, 3.0), (3, 4.0)], None, None)], schemas.LEVEL_PAYLOAD)
    got = {(r["timestamp"], r["result_quality"]) for r in flatten_levels(levels).collect()}
    assert got == {(1, "approved"), (2, "unapproved"), (3, "unapproved")}


def test_observation_parameters_leave_out_nulls(spark):
    rows = spark.createDataFrame([("COA", None, "Y"), (None, None, None)],
                                 "facility_code string, measurement_method string, "
                                 "dry_indicator_yn string")
    got = [r["m"] for r in rows.select(observation_parameters().alias("m")).collect()]
    assert got == [{"measuring_agency": "COA", "water_level_status": "Y"}, None]


def test_several_properties_per_station(spark):
    rows = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, 3.0)],
                                 "location_id string, depth double, head double")
    got = mapping.property_rows(rows, {"dtw": "depth", "gwe": "head"})
    assert {(r["location_id"], r["suffix"], r["value"]) for r in got.collect()} == {
        ("A", "dtw", 1.0), ("A", "gwe", 2.0), ("B", "gwe", 3.0)}
    obs = mapping.observations(got, "CABQ", F.lit(None).cast("timestamp"), F.col("value"),
                               suffix=F.col("suffix"))
    assert "cabq-B-gwe" in {r["datastream_key"] for r in obs.collect()}
