"""Session settings, the durable scratch folder, and lineage cuts."""

import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job of this package relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def durable_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stillwell-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the durable folder, so later reads neither recompute nor vary."""
    durable_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """``settle`` with aggregates over the rows, taken by the same job."""
    seen = Observation()
    kept = settle(df.observe(seen, *metrics))
    return kept, observed(seen, kept, *metrics)


def observed(seen: Observation, written: DataFrame, *metrics: Column) -> dict:
    """What a job observed. A job whose rows were planned away has observed nothing; then what it
    wrote, which is empty, is asked."""
    try:
        return seen.get
    except Py4JJavaError:
        return written.agg(*metrics).first().asDict()
