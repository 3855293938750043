import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.operators.filters import depth_rows
from stillwell.sinks import raw as raw_sink
from stillwell.sinks.raw import append_load, append_loads, load_folder, replace_stations
from stillwell.sources import scan

SCHEMA = schemas.LOGGER_READINGS


def rows_of(spark, *rows):
    return spark.createDataFrame(
        [(f"{l}_{p}_{t}", l, t, p, "35", 1.0) for l, p, t in rows], SCHEMA)


@pytest.fixture
def raw(spark, tmp_path):
    """Files named by their load, as an ingest library writes them."""
    root = tmp_path / "raw"

    def put(name, *rows):
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        made = tmp_path / "made" / name.replace("/", "_")
        rows_of(spark, *rows).coalesce(1).write.parquet(str(made))
        shutil.copy(next(made.glob("*.parquet")), target)

    put("year=2024/month=01/day=01/100.0.0.parquet", (1, "4", 10))
    put("year=2024/month=01/day=02/200.0.0.parquet", (1, "4", 20), (1, "1", 20))
    put("year=2024/month=01/day=02/200.0.1.parquet", (2, "4", 21))
    put("year=2024/month=01/day=03/300.0.0.parquet", (1, "33", 30))
    put("year=2024/month=01/day=03/not-a-load-id.parquet", (9, "4", 90))
    return str(root)


@pytest.mark.parametrize("name, expected", [
    ("gs://b/t/year=2024/month=06/day=18/1781192390.555875.0.parquet", 1781192390.555875),
    ("/t/100.0.1.parquet", 100.0), ("/t/not-a-load-id.parquet", None), ("/t/README.parquet", None),
    ("/t/year=2024/load_id=1781192390.555875/part-0.snappy.parquet", 1781192390.555875),
    ("/t/load_id=7.5/8.25.0.parquet", 7.5), ("/load_id=7.5/part-0.parquet", 7.5),
    ("/t/load_id=7.5/more/part-0.parquet", None), ("/t/load_id=7/part-0.parquet", None),
    ("/t/xload_id=7.5/part-0.parquet", None), ("load_id=7.5/part-0.parquet", None),
    ("/1.5.x", 1.5), ("1.5.parquet", None), (None, None),
])
def test_load_id_of_a_path(spark, name, expected):
    assert spark.range(1).select(scan.load_id_of(F.lit(name)).alias("x")).first()["x"] == expected


def test_a_scan_searches_the_end_of_each_path_once_a_bound(spark, raw, capsys):
    scan.scan_new(spark, raw, SCHEMA, until=250.0).select("timestamp").explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
    rows = plan.split("== Physical Plan ==")[0]
    assert rows.count("regexp_extract(") == rows.count("regexp_extract(substring_index(") == 2


def test_first_scan_reads_every_named_file(spark, raw):
    got = sorted(r["timestamp"] for r in scan.scan_new(spark, raw, SCHEMA).collect())
    assert got == [10, 20, 20, 21, 30]


def test_later_scan_skips_loads_at_or_below_the_mark(spark, raw):
    rows = scan.scan_new(spark, raw, SCHEMA, 200.0)
    assert [(r["timestamp"], r["load_id"]) for r in rows.collect()] == [(30, 300.0)]


def test_files_of_old_loads_are_never_opened(spark, raw):
    pathlib.Path(raw, "year=2024/month=01/day=01/100.0.0.parquet").write_bytes(b"broken")
    assert scan.scan_new(spark, raw, SCHEMA, 100.0).count() == 4
    assert scan.scan_load(spark, raw, SCHEMA, 200.0).count() == 3


def test_depth_filter_reaches_the_files(spark, raw, capsys):
    rows = depth_rows(scan.scan_new(spark, raw, SCHEMA))
    assert rows.count() == 3
    rows.select("value").explain("formatted")
    text = capsys.readouterr().out
    assert "EqualTo(parameter_id,4)" in text
    assert "ReadSchema: struct<parameter_id:string,value:double>" in text


def test_newest_load_counts_files_not_rows(spark, raw):
    assert scan.newest_load(spark, raw) == 300.0
    assert scan.newest_load(spark, raw, 400.0) == 400.0
    assert depth_rows(scan.scan_new(spark, raw, SCHEMA, 200.0)).count() == 0


def test_exact_load_reads_all_its_files(spark, raw):
    rows = scan.scan_load(spark, raw, SCHEMA, 200.0).collect()
    assert sorted(r["timestamp"] for r in rows) == [20, 20, 21]


def test_nothing_written_yet(spark, tmp_path):
    root = str(tmp_path / "none")
    assert scan.newest_load(spark, root) is None
    assert scan.scan_new(spark, root, SCHEMA, 1.0).count() == 0


def test_a_load_can_be_written_again(spark, tmp_path):
    root = str(tmp_path / "t")
    for rows in (rows_of(spark, (1, "4", 1), (1, "4", 2)), rows_of(spark, (1, "4", 3))):
        append_load(rows, root, 1781192390.555875)
    got = scan.scan_load(spark, root, SCHEMA, 1781192390.555875)
    assert [r["timestamp"] for r in got.collect()] == [3]
    assert "/year=2026/month=06/day=11/" in load_folder(root, 1781192390.555875)


def test_an_empty_load_still_counts(spark, tmp_path):
    root = str(tmp_path / "t")
    append_load(rows_of(spark).limit(0), root, 100.5)
    assert scan.newest_load(spark, root) == 100.5


def test_many_loads_in_one_write(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = rows_of(spark, (1, "4", 1), (1, "4", 2)).withColumn(
        "load_id", F.col("timestamp") + F.lit(0.25))
    append_loads(rows, root)
    assert {r["load_id"] for r in scan.list_loads(spark, root).collect()} == {1.25, 2.25}


def test_new_loads_are_found_in_any_folder(spark, tmp_path):
    root = tmp_path / "t"
    own = [1767139200.5, 1769817600.5, 1769990400.5]
    for load_id in own:
        append_load(rows_of(spark, (1, "4", 1)), str(root), load_id)

    def foreign(folder, load_id):
        made = str(tmp_path / f"one-{load_id}")
        rows_of(spark, (2, "4", 2)).coalesce(1).write.parquet(made)
        (root / folder).mkdir(parents=True, exist_ok=True)
        part = next(pathlib.Path(made).glob("part-*"))
        shutil.copy(part, root / folder / f"{load_id:.6f}.0.parquet")

    foreign("year=2024/month=01/day=01", 1769990401.5)  # a new load in an old folder
    foreign("copied", 1950000000.25)  # far ahead, outside the dated pattern
    foreign("year=2024/month=01/day=02", 1700000000.5)

    def listed(since):
        paths = scan.paths_since(spark, str(root), since)
        return sorted({r["load_id"] for r in scan.list_loads(spark, paths).collect()})

    assert listed(None) == sorted([*own, 1769990401.5, 1950000000.25, 1700000000.5])
    assert listed(own[1]) == [own[2], 1769990401.5, 1950000000.25]
    assert listed(2e9) == [] and scan.paths_since(spark, str(tmp_path / "none"), 1.0) == []
    paths = scan.paths_since(spark, str(root), own[2])
    assert scan.newest_load(spark, paths, own[2]) == 1950000000.25
    assert scan.scan_new(spark, paths, SCHEMA, own[2]).count() == 2
    assert scan.newest_load(spark, [], own[2]) == own[2]
    assert scan.scan_new(spark, [], SCHEMA, own[2]).count() == 0


def test_station_scan_keeps_the_last_row(spark, tmp_path):
    root = str(tmp_path / "stations")
    with pytest.raises(FileNotFoundError):
        scan.scan_stations(spark, root, schemas.LOGGER_STATIONS)
    table = spark.createDataFrame(
        [(1, "old", "", 1.0, 2.0), (2, "two", "", 1.0, 2.0), (1, None, "", 3.0, 4.0)],
        schemas.LOGGER_STATIONS).coalesce(1)
    replace_stations(table, root)
    got = {r["id"]: r["name"] for r in
           scan.scan_stations(spark, root, schemas.LOGGER_STATIONS).collect()}
    assert got == {1: None, 2: "two"}
    replace_stations(table.where("id = 2"), root)
    assert scan.scan_stations(spark, root, schemas.LOGGER_STATIONS).count() == 1


def test_a_load_with_a_folder_of_its_own_lists_no_other(spark, tmp_path):
    root = tmp_path / "raw"
    append_load(rows_of(spark, (1, "4", 10)), str(root), 1781192390.5)
    other = root / "year=2020/month=01/day=01/load_id=1577836800.000000"
    other.mkdir(parents=True)
    (other / "part-0.parquet").write_bytes(b"broken")
    (root / "elsewhere").mkdir()
    (root / "elsewhere").chmod(0)  # a folder nobody may list
    try:
        assert scan.scan_load(spark, str(root), SCHEMA, 1781192390.5).count() == 1
    finally:
        (root / "elsewhere").chmod(0o755)


def test_names_of_loads_are_not_shuffled(spark, capsys):
    rows = rows_of(spark, (1, "4", 10)).withColumn("load_id", F.lit(100.0) + F.rand())
    raw_sink._placed(rows, "load_id").explain()
    plan = capsys.readouterr().out
    assert plan.index("format_string") < plan.index("Exchange")
    assert plan.count("format_string") == 1


def test_loads_of_one_name_share_their_folder_and_bounds(spark, tmp_path):
    rows = rows_of(spark, (1, "4", 10), (1, "4", 70)).withColumn(
        "load_id", F.when(F.col("timestamp") == 10, 100.0).otherwise(100.0000001))
    append_loads(rows, str(tmp_path / "raw"))
    assert [i for _, i in scan.named_loads(spark, str(tmp_path / "raw"))] == [100.0]
    for at in (10, 70):
        assert raw_sink.loads_meeting(spark, str(tmp_path / "raw"), at, at + 1)
    assert not raw_sink.loads_meeting(spark, str(tmp_path / "raw"), 71, 99)
    assert scan.scan_load(spark, str(tmp_path / "raw"), SCHEMA, 100.0).count() == 2
