"""The daily job as a stream: each new raw file once, through the same batch load."""

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell.plans.daily import load_batch
from stillwell.session import pin
from stillwell.sinks import state as progress
from stillwell.sinks.zone import Zone
from stillwell.sources.scan import load_id_of
from stillwell.sources.specs import SourceSpec


def raw_stream(
    spark: SparkSession, root: str, spec: SourceSpec, *, max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """New files of the raw zone with their load id, file and row; ``max_files`` or ``max_bytes``
    bound a batch, which takes the oldest files first."""
    files = spark.readStream.schema(spec.schema).option("recursiveFileLookup", "true")
    for name, value in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        if value is not None:
            files = files.option(name, value)
    rows = files.parquet(root)
    return rows.select(
        *spec.schema.names,
        load_id_of(F.col("_metadata.file_path")).alias("load_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).where(F.col("load_id").isNotNull())


def run_stream(
    spark: SparkSession, spec: SourceSpec, zone: Zone, checkpoint: str,
    *, stations: DataFrame | None = None, max_files: int | None = None,
    max_bytes: int | None = None,
) -> list[dict]:
    """Load everything that arrived since the last run, then stop.

    A run takes as many batches as the bounds ask for, one report each; without bounds it is one
    batch, whose size is that of the backlog.

    The file position is Spark's own checkpoint, which moves only after the batch function
    returns. A failed batch is offered again with the same files under the same number, so
    it overwrites its own partitions; one whose progress was already committed is skipped.
    """
    pin(spark)
    reports, known, started = [], {}, threading.Event()
    place = zone.progress(spec.dataset)

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        started.wait()
        mark = f"{spec.dataset}_stream_{known['id']}"
        done = progress.last_of(progress.positions(session, place, progress.LOAD), mark)
        if done is not None and number <= done:
            return
        reports.append(load_batch(
            session, spec, zone, batch, batch=f"stream-{known['id']}-{number:010d}",
            scope=spec.dataset, stations=stations,
            extra_state=progress.number_rows(session, mark, number),
        ))

    query = (
        raw_stream(spark, zone.raw(spec), spec, max_files=max_files, max_bytes=max_bytes)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    # The id belongs to the checkpoint: a new checkpoint counts its batches anew.
    known["id"] = query.id
    started.set()
    query.awaitTermination()
    return reports
