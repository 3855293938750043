from datetime import datetime, timezone

from pyspark.sql import functions as F

from stillwell.functions import (
    centimetres_to_feet, chunk_key, datastream_key, from_iso, iso_text, location_key,
    metres_to_feet, millis_to_seconds, odata_text, reading_id, seconds_of_date,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def at(text):
    return F.lit(datetime.fromisoformat(text).replace(tzinfo=timezone.utc))


def test_keys_are_lower_case_and_keep_the_id(spark):
    assert one(spark, location_key("PVACD", F.lit(4745648669458432))) == "pvacd-4745648669458432"
    assert one(spark, datastream_key("CABQ", F.lit("IW4"))) == "cabq-IW4-dtw"


def test_a_null_id_gives_a_null_key(spark):
    assert one(spark, location_key("PVACD", F.lit(None).cast("string"))) is None


def test_reading_ids(spark):
    assert one(spark, reading_id(F.lit(1), F.lit("4"), F.lit(99))) == "1_4_99"
    assert one(spark, reading_id(F.lit("IW4"), F.lit(1391079600000))) == "IW4_1391079600000"


def test_chunk_key_sorts_its_ids(spark):
    key = chunk_key(at("2026-01-01"), at("2026-02-01"), F.array(F.lit(222), F.lit(111)))
    assert one(spark, key) == "2026-01-01T00:00:00+00:00_2026-02-01T00:00:00+00:00_111,222"


def test_numeric_ids_sort_as_numbers(spark):
    key = chunk_key(at("2026-01-01"), at("2026-02-01"), F.array(F.lit(111), F.lit(9)))
    assert one(spark, key).endswith("_9,111")


def test_iso_text_prints_microseconds_only_if_any(spark):
    assert one(spark, iso_text(at("2026-01-01T00:00:00"))) == "2026-01-01T00:00:00+00:00"
    assert one(spark, iso_text(at("2026-01-01T00:00:00.000120"))).endswith("00.000120+00:00")
    assert one(spark, odata_text(at("2026-01-01T00:00:00"))) == "2026-01-01T00:00:00Z"


def test_iso_text_reads_back(spark):
    back = one(spark, F.unix_micros(from_iso(F.lit("2026-06-16T18:00:00+00:00"))))
    assert back == 1781632800000000
    assert one(spark, from_iso(F.lit("not a time"))) is None


def test_milliseconds_truncate_toward_zero(spark):
    assert one(spark, millis_to_seconds(F.lit(1999).cast("bigint"))) == 1
    assert one(spark, millis_to_seconds(F.lit(-1999).cast("bigint"))) == -1


def test_units(spark):
    assert abs(one(spark, metres_to_feet(F.lit(10.0))) - 32.8084) < 1e-9
    assert abs(one(spark, centimetres_to_feet(F.lit(612.648))) - 20.1) < 1e-9


def test_date_to_seconds():
    assert seconds_of_date("2026-05-01") == 1777593600
