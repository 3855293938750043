"""The supplied tables in the roles of readings, stations and progress.

``events`` plays the logger readings (user = station, type = parameter), ``supplier`` their
station table, ``lineitem`` the readings of the city wells and ``orders`` a fetch log. Each
DataFrame here has a SQL text of the same name and meaning in ``PARTS``.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell.session import durable_dir, pin

DAY = 86400
EPOCH_2024 = 1704067200
CITY_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"]

SHAPES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

PARTS = {
    "readings": """readings AS (
      SELECT concat(user_id, '_', code, '_', sec) AS reading_id, user_id AS location_id,
             sec AS "timestamp", code AS parameter_id,
             CASE event_type WHEN 'click' THEN '1' WHEN 'error' THEN '241' ELSE '35' END AS unit_id,
             CASE WHEN value >= 250 THEN NULL ELSE value END AS value,
             CAST(sec - sec % 86400 + CASE WHEN value > 100 THEN 259200 ELSE 0 END AS DOUBLE)
               AS load_id, event_id
      FROM (SELECT *, epoch_us(ts) // 1000000 AS sec,
                   CASE event_type WHEN 'view' THEN '4' WHEN 'click' THEN '1'
                     WHEN 'error' THEN '33' WHEN 'purchase' THEN '2' ELSE '3' END AS code
            FROM events))""",
    "stations": """stations AS (
      SELECT s_suppkey AS id, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END AS name,
             CAST(s_nationkey AS VARCHAR) AS description,
             s_acctbal / 100 AS latitude, s_acctbal / -50 AS longitude FROM supplier)""",
    "obs": """failed AS (
      SELECT DISTINCT location_id FROM readings WHERE parameter_id = '4' AND value IS NULL),
    obs AS (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             "timestamp" * 1000000 AS time_us, value * CAST(3.28084 AS DOUBLE) AS result,
             location_id, event_id, load_id
      FROM readings WHERE parameter_id = '4'
        AND location_id NOT IN (SELECT location_id FROM failed))""",
    "stored": """stored AS (
      SELECT concat('pvacd-', s_suppkey, '-dtw') AS datastream_key,
             CAST((1704067200 + s_nationkey * 86400) AS BIGINT) * 1000000 AS watermark_us
      FROM supplier WHERE s_acctbal > 0)""",
    "existing": """existing AS (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             "timestamp" * 1000000 AS time_us, value AS result
      FROM readings WHERE parameter_id = '1')""",
    "cursors": """cursors AS (
      SELECT s_suppkey AS location_id,
             CAST(1704067200 + s_nationkey * 90000 AS BIGINT) AS cursor
      FROM supplier WHERE s_acctbal > 0)""",
    "city": """city AS (
      SELECT concat('W', l_suppkey, '_', epoch_ms(l_shipdate)) AS reading_id,
             concat('W', l_suppkey) AS location_id,
             CASE WHEN l_linenumber % 3 = 0 THEN NULL
               ELSE concat('Well ', l_suppkey, '-', l_linenumber) END AS location_name,
             l_linenumber + 34.5 AS latitude, CAST(l_suppkey AS DOUBLE) AS longitude,
             epoch_ms(l_shipdate) AS "timestamp",
             CASE WHEN l_quantity = 50 THEN NULL ELSE l_quantity END AS value,
             CAST(year(l_shipdate) AS DOUBLE) AS load_id, l_linestatus AS file,
             (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS row,
             l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate
      FROM lineitem)""",
    "log": """log AS (
      SELECT CAST(o_custkey AS VARCHAR) AS location_id, o_orderkey AS attempt,
             CASE o_orderpriority WHEN '1-URGENT' THEN 200
               WHEN '2-HIGH' THEN CASE WHEN o_orderstatus = 'P' THEN 403 ELSE 404 END
               WHEN '3-MEDIUM' THEN 429 WHEN '4-NOT SPECIFIED' THEN 503 END AS status,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'timeout' END AS error
      FROM orders),
    outcomes AS (
      SELECT location_id, CASE WHEN status IS NULL OR error IS NOT NULL THEN 'error'
               WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 404 THEN 'no_data'
               WHEN status = 429 OR status >= 500 THEN 'error' ELSE 'fatal' END AS outcome
      FROM log QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY attempt DESC) = 1)""",
}


def with_parts(*names: str) -> str:
    return "WITH " + ",\n    ".join(PARTS[name] for name in names) + "\n"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    pin(spark)
    return spark.read.schema(SHAPES[name]).parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the durable one for this call only."""
    return f"{durable_dir(spark)}/stillwell-{uuid.uuid4().hex}/{name}"


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Logger readings with their load id and arrival order."""
    events = table(spark, folder, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    kind = F.col("event_type")
    code = (
        F.when(kind == "view", "4").when(kind == "click", "1").when(kind == "error", "33")
        .when(kind == "purchase", "2").otherwise("3")
    )
    unit = F.when(kind == "click", "1").when(kind == "error", "241").otherwise("35")
    late = F.when(F.col("value") > 100, F.lit(3 * DAY)).otherwise(F.lit(0))
    return events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), code, F.lit("_"),
                 second.cast("string")).alias("reading_id"),
        F.col("user_id").alias("location_id"), second.alias("timestamp"),
        code.alias("parameter_id"), unit.alias("unit_id"),
        F.when(F.col("value") < 250, F.col("value")).alias("value"),
        (second - second % DAY + late).cast("double").alias("load_id"),
        F.lit("").alias("file"), F.col("event_id").alias("row"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_nationkey") != 3, F.col("s_name")).alias("name"),
        F.col("s_nationkey").cast("string").alias("description"),
        (F.col("s_acctbal") / 100).alias("latitude"),
        (F.col("s_acctbal") / -50).alias("longitude"),
    )


def stored_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0)
    return suppliers.select(
        F.concat(F.lit("pvacd-"), F.col("s_suppkey").cast("string"), F.lit("-dtw"))
        .alias("datastream_key"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("s_nationkey") * DAY).alias("watermark"),
    )


def existing(spark: SparkSession, folder: str) -> DataFrame:
    """Observations already in the target: the clicks, under the depth key."""
    clicks = readings(spark, folder).where(F.col("parameter_id") == "1")
    return clicks.select(
        F.concat(F.lit("pvacd-"), F.col("location_id").cast("string"), F.lit("-dtw"))
        .alias("datastream_key"),
        F.timestamp_seconds("timestamp").alias("phenomenon_time"),
        F.col("value").alias("result"),
    )


def cursors(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0)
    return suppliers.select(
        F.col("s_suppkey").alias("location_id"),
        (F.lit(EPOCH_2024) + F.col("s_nationkey") * 90000).cast("bigint").alias("cursor"),
    )


def city(spark: SparkSession, folder: str) -> DataFrame:
    """City-well readings with their arrival order; ``CITY_ORDER`` tells all rows apart."""
    lines = table(spark, folder, "lineitem")
    millis = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    well = F.concat(F.lit("W"), F.col("l_suppkey").cast("string"))
    name = F.concat(F.lit("Well "), F.col("l_suppkey").cast("string"), F.lit("-"),
                    F.col("l_linenumber").cast("string"))
    return lines.select(
        F.concat(well, F.lit("_"), millis.cast("string")).alias("reading_id"),
        well.alias("location_id"),
        F.when(F.col("l_linenumber") % 3 != 0, name).alias("location_name"),
        (F.col("l_linenumber") + 34.5).alias("latitude"),
        F.col("l_suppkey").cast("double").alias("longitude"),
        millis.alias("timestamp"),
        F.when(F.col("l_quantity") != 50, F.col("l_quantity")).alias("value"),
        F.year("l_shipdate").cast("double").alias("load_id"), F.col("l_linestatus").alias("file"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey"))
        .alias("row"),
        *CITY_ORDER,
    )


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    level = F.col("o_orderpriority")
    refused = F.when(F.col("o_orderstatus") == "P", 403).otherwise(404)
    return orders.select(
        F.col("o_custkey").cast("string").alias("location_id"),
        F.col("o_orderkey").alias("attempt"),
        F.when(level == "1-URGENT", 200).when(level == "2-HIGH", refused)
        .when(level == "3-MEDIUM", 429).when(level == "4-NOT SPECIFIED", 503).alias("status"),
        F.when(level == "5-LOW", "timeout").alias("error"),
    )


def flat(obs: DataFrame, *more: str) -> DataFrame:
    """Observations with their time as microseconds, for comparison."""
    return obs.select(
        "datastream_key", F.unix_micros("phenomenon_time").alias("time_us"), "result", *more
    )
