"""The observation table: parquet by agency, generation, observation month and batch.

Every write goes into folders of a new generation, and one commit names the generation that is live
in each folder it touches (positions as in ``state``, beside the table). Until then readers see the
old rows, and afterwards the new ones; nothing that is live is ever changed in place. So an attempt
that stops at any point leaves the table as it was, and what it wrote is never read.

With every generation goes a summary: rows, first and last time of each datastream and month. The
latest stored time of a datastream comes from there, without opening the months themselves.
"""

import time
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillwell import schemas
from stillwell.files import escaped, holding, remove, unescaped
from stillwell.operators.joins import BROADCAST_ROWS, lookup_join, settle_measured
from stillwell.operators.windows import (
    accepted, deleted_by, kept_by, outside_span, require_span, summed_results,
)
from stillwell.sinks.state import commit_state, positions

FOLDERS = ["agency", "generation", "obs_month", "batch"]
OWN = ["obs_month", "batch"]
FOLDER = "folder"


@dataclass(frozen=True)
class Folder:
    """A live folder; ``generation`` is odd where the folder lost all its rows."""

    agency: str
    month: str
    batch: str
    generation: int

    @property
    def held(self) -> bool:
        return self.generation % 2 == 0

    def path(self, spark: SparkSession, root: str) -> str:
        month, batch = escaped(spark, self.month), escaped(spark, self.batch)
        return f"{_place(spark, root, self.agency, self.generation)}/obs_month={month}/batch={batch}"


def _place(spark: SparkSession, root: str, agency: str, generation: int) -> str:
    """Where one attempt writes, and no other."""
    return f"{root}/agency={escaped(spark, agency.upper())}/generation={generation}"


def _commits(root: str) -> str:
    return f"{root}_folders"


def _summaries(root: str) -> str:
    return f"{root}_summary"


def live_folders(
    spark: SparkSession, root: str, agency: str | None = None, months: list[str] | None = None
) -> list[Folder]:
    """The live folders by name: what any read of the table opens, and nothing else."""
    found = positions(spark, _commits(root), FOLDER)
    folders = [Folder(scope, *key.split("/", 1), n) for (scope, _, key), n in found.items()]
    return [f for f in folders if (agency is None or f.agency == agency.upper())
            and (months is None or f.month in months)]


def _read(spark: SparkSession, root: str, folders: list[Folder]) -> DataFrame:
    shape = schemas.STORED_OBSERVATION
    paths = [f.path(spark, root) for f in folders if f.held]
    if not paths:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).option("basePath", root).parquet(*paths)


def read_observations(
    spark: SparkSession, root: str, agency: str | None = None, months: list[str] | None = None
) -> DataFrame:
    """Live observations, of one agency or some months if named; other folders are not listed."""
    return _read(spark, root, live_folders(spark, root, agency, months))


def read_summary(spark: SparkSession, root: str, folders: list[Folder]) -> DataFrame:
    """``obs_month, batch, datastream_key, rows, oldest, newest`` of the given folders."""
    kept = [f for f in folders if f.held]
    paths = {_place(spark, _summaries(root), f.agency, f.generation) for f in kept}
    if not paths:
        return spark.createDataFrame([], schemas.SUMMARY)
    rows = spark.read.schema(schemas.STORED_SUMMARY).option(
        "basePath", _summaries(root)).parquet(*sorted(paths))
    # A generation may hold folders that a later one has replaced.
    live = spark.createDataFrame([(f.agency, f.generation, f.month, f.batch) for f in kept],
                                 "agency string, generation bigint, obs_month string, batch string")
    return lookup_join(rows, live, FOLDERS, "left_semi", small=len(kept) <= BROADCAST_ROWS).select(
        *schemas.SUMMARY.names)


def newest_stored(
    spark: SparkSession, root: str, agency: str, *, without_batch: str | None = None
) -> DataFrame:
    """Latest stored time per datastream, from the summaries alone."""
    folders = [f for f in live_folders(spark, root, agency) if f.batch != without_batch]
    return read_summary(spark, root, folders).groupBy("datastream_key").agg(
        F.max("newest").alias("watermark"))


def _generation(folders: list[Folder]) -> int:
    """Later than all before; even, since it holds rows."""
    return max([time.time_ns() // 1000 * 2, *(f.generation + 2 - f.generation % 2 for f in folders)])


def _placed(obs: DataFrame, batch: str) -> DataFrame:
    return obs.select(
        *schemas.OBSERVATION.names,
        F.date_format("phenomenon_time", "yyyy-MM").alias("obs_month"),
        F.lit(batch).alias("batch"),
    )


def _add(rows: DataFrame, place: str) -> None:
    # Rebalancing by folder gives well-sized files and splits an oversized folder; sorting
    # inside files lets readers of one datastream skip row groups.
    spread = rows.hint("rebalance", *[F.col(c) for c in OWN])
    ordered = spread.sortWithinPartitions(*OWN, "datastream_key", "phenomenon_time")
    ordered.write.mode("append").partitionBy(*OWN).parquet(place)


def _written(spark: SparkSession, root: str, agency: str, generation: int) -> list[Folder]:
    """The folders of a generation, by name."""
    found = []
    for path in holding(spark, f"{_place(spark, root, agency, generation)}/obs_month=*/batch=*"):
        month, batch = (unescaped(spark, part.split("=", 1)[1]) for part in path.split("/")[-2:])
        found.append(Folder(agency.upper(), month, batch, generation))
    return found


def _counted(rows: DataFrame) -> DataFrame:
    """The summary of stored rows; two narrow columns are read."""
    return rows.groupBy(*OWN, "datastream_key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("phenomenon_time").alias("oldest"),
        F.max("phenomenon_time").alias("newest"))


def _commit(
    spark: SparkSession, root: str, agency: str, generation: int,
    held: list[Folder], touched: list[Folder],
) -> None:
    """Make ``held`` live in one step; other folders of ``touched`` are empty from now on."""
    full = {(f.month, f.batch) for f in held}
    rows = [(agency.upper(), FOLDER, f"{m}/{b}", generation) for m, b in sorted(full)]
    gone = {(f.month, f.batch) for f in touched if f.held} - full
    rows += [(agency.upper(), FOLDER, f"{m}/{b}", generation + 1) for m, b in sorted(gone)]
    if rows:
        named = spark.createDataFrame(rows, schemas.STATE).coalesce(1)
        commit_state(spark, _commits(root), named)


def write_batch(obs: DataFrame, root: str, agency: str, batch: str) -> DataFrame:
    """Write the observations of one batch; all or nothing. Returns their summary.

    What an earlier attempt of the same batch wrote is replaced by the same commit.
    """
    spark = obs.sparkSession
    earlier = [f for f in live_folders(spark, root, agency) if f.batch == batch]
    generation = _generation(earlier)
    _add(_placed(accepted(obs), batch), _place(spark, root, agency, generation))
    folders = _written(spark, root, agency, generation)
    own = _place(spark, _summaries(root), agency, generation)
    _counted(_read(spark, root, folders)).write.parquet(own)
    _commit(spark, root, agency, generation, folders, earlier)
    return spark.read.schema(schemas.SUMMARY).parquet(own)


def months_of(start: datetime, end: datetime) -> list[str]:
    """Calendar months the half-open window touches."""
    months, at = [], start.replace(day=1)
    while at < end:
        months.append(f"{at:%Y-%m}")
        at = (at + timedelta(days=32)).replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return months


def replace_window_in_place(
    spark: SparkSession, root: str, agency: str, batch: str, new: DataFrame,
    start: datetime, end: datetime, watermarks: DataFrame, keys: DataFrame | None = None,
    *, few_marks: bool | None = None,
) -> DataFrame:
    """Replace ``[start, end)`` of every datastream in ``new`` and return counts per
    datastream. ``keys`` may name more datastreams, whose window is then cleared as well.

    New rows, and the survivors of every folder that loses a row, are written beside the live
    folders and switched by one commit. Rows outside the window are live at any point; so are
    the old rows of the window until the new ones are.
    """
    live = live_folders(spark, root, agency, months_of(start, end))
    generation = _generation(live)
    place = _place(spark, root, agency, generation)
    own = _place(spark, _summaries(root), agency, generation)
    _add(_placed(accepted(new.select(*schemas.OBSERVATION.names)), batch), place)
    written = _written(spark, root, agency, generation)
    posted, small, span = settle_measured(_counted(_read(spark, root, written)),
                                          *outside_span(start, end))
    try:
        require_span(span, start, end)
    except ValueError:
        remove(spark, place)
        raise
    wanted = posted.select("datastream_key").distinct()
    if keys is not None or not small:
        named = [] if keys is None else [keys.select("datastream_key")]
        wanted, small, _ = settle_measured(reduce(
            DataFrame.unionByName, named, posted.select("datastream_key")).distinct())
    losses, touched = None, []
    if any(f.held for f in live):
        # The folders that lose a row are told by the same job that counts the losses.
        at = F.collect_set(F.struct(*OWN)).alias("hit")
        losses, _, seen = settle_measured(
            deleted_by(_read(spark, root, live), wanted, start, end, small=small)
            .groupBy(*OWN, "datastream_key").agg(F.count(F.lit(1)).alias("n")), at)
        # A folder of this batch is replaced as a whole: rows of other datastreams move along.
        hit = {tuple(r) for r in seen["hit"]} | {(f.month, f.batch) for f in written}
        touched = [f for f in live if f.held and (f.month, f.batch) in hit]
    summary = posted
    if touched:
        kept = kept_by(_read(spark, root, touched), wanted, start, end, small=small)
        _add(kept.drop("agency"), place)
        written = _written(spark, root, agency, generation)
        summary = _counted(_read(spark, root, written))
    summary.write.parquet(own)
    _commit(spark, root, agency, generation, written, touched)
    return summed_results(posted, losses, watermarks, small=few_marks or None)


def sweep(spark: SparkSession, root: str, agency: str, before: datetime) -> int:
    """Remove folders begun before a time that no commit names any more; returns their number.

    Give a time that no running attempt and no running reader goes back to.
    """
    live = {f.path(spark, root) for f in live_folders(spark, root, agency) if f.held}
    limit, removed = int(before.timestamp() * 2_000_000), 0
    for place in holding(spark, f"{root}/agency={escaped(spark, agency.upper())}/generation=*"):
        generation = int(place.rsplit("=", 1)[1])
        if generation >= limit:
            continue
        folders = _written(spark, root, agency, generation)
        dead = [f.path(spark, root) for f in folders if f.path(spark, root) not in live]
        whole = len(dead) == len(folders)
        for path in [place, _place(spark, _summaries(root), agency, generation)] if whole else dead:
            remove(spark, path)
        removed += len(dead)
    return removed
