"""Insert-only upsert of the entity tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell import schemas
from stillwell.files import exists
from stillwell.operators.entities import missing_keys
from stillwell.operators.joins import lookup_join, settle_measured
from stillwell.sinks.zone import Zone
from stillwell.sources.scan import read_or_empty

ROWS_PER_FILE = 1_000_000


def read_entity(spark: SparkSession, zone: Zone, name: str) -> DataFrame:
    return read_or_empty(spark, zone.entity(name), schemas.ENTITIES[name])


def upsert_entities(spark: SparkSession, zone: Zone, tables: dict[str, DataFrame]) -> dict:
    """Append the missing rows of each table in foreign-key order; counts per table.

    One job finds the keys that all tables miss and counts them, and only tables that miss
    something are written.
    """
    names = [name for name in schemas.ENTITIES if name in tables]
    held = {name for name in names if exists(spark, zone.entity(name))}

    def keys(of):
        return reduce(DataFrame.unionByName, [
            of(name).select(F.lit(name).alias("entity"), "external_key") for name in names])

    missing, small, seen = settle_measured(
        missing_keys(keys(tables.get), keys(lambda name: read_entity(spark, zone, name))),
        *[F.count_if(F.col("entity") == name).alias(name) for name in names],
        F.max("copies").alias("copies"),
    )
    for name in names:
        if seen[name]:
            rows = tables[name]
            if name in held:  # an empty table misses all
                own = missing.where(F.col("entity") == name).select("external_key")
                rows = lookup_join(rows, own, "external_key", "left_semi", small=small)
            if seen["copies"] > 1:
                rows = rows.dropDuplicates(["external_key"])
            files = -(-seen[name] // ROWS_PER_FILE)
            rows.coalesce(files).write.mode("append").parquet(zone.entity(name))
    return {name: seen[name] for name in names}
