import json

import pytest
from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.sinks import state as progress


def state(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STATE)


def held(spark, root):
    return {(r["kind"], r["key"]): r["position"] for r in progress.read_state(spark, root).collect()}


def test_missing_state_is_empty(spark, tmp_path):
    assert progress.read_state(spark, str(tmp_path / "none")).count() == 0


def test_commits_merge_and_never_move_back(spark, tmp_path):
    root = str(tmp_path / "s")
    assert progress.commit_state(spark, root, state(spark, ("x", "watermark", "a", 5))) == 1
    progress.commit_state(spark, root, state(spark, ("x", "watermark", "a", 3),
                                             ("x", "watermark", "b", 1)))
    progress.commit_state(spark, root, state(spark, ("x", "watermark", "a", 9)))
    assert held(spark, root) == {("watermark", "a"): 9, ("watermark", "b"): 1}


def test_an_unfinished_snapshot_does_not_count(spark, tmp_path):
    root = str(tmp_path / "s")
    progress.commit_state(spark, root, state(spark, ("x", "load", "last", 5)))
    state(spark, ("x", "load", "last", 99)).write.parquet(f"{root}/c0000000002-lost")
    (tmp_path / "s/c0000000002-lost/_SUCCESS").unlink()
    assert held(spark, root) == {("load", "last"): 5}
    progress.commit_state(spark, root, state(spark, ("x", "load", "last", 6)))
    assert held(spark, root) == {("load", "last"): 6}


def test_load_ids_survive_the_round_trip(spark, tmp_path):
    root = str(tmp_path / "s")
    progress.commit_state(spark, root, progress.load_rows(spark, "x", 1781192390.555875))
    assert progress.last_load(progress.read_state(spark, root), "x") == 1781192390.555875
    assert progress.last_load(progress.read_state(spark, root), "other") is None


def test_scopes_are_apart(spark):
    both = state(spark, ("raw", "watermark", "a", 1), ("raw_backfill", "watermark", "a", 2))
    assert progress.watermarks(both, "raw").select(F.unix_micros("watermark")).first()[0] == 1


def test_import_of_json_watermarks(spark, tmp_path):
    path = tmp_path / "w.json"
    assert progress.import_watermarks(spark, str(path)).count() == 0
    path.write_text(json.dumps({"pvacd-1-dtw": "2026-06-16T18:00:00+00:00"}, indent=2))
    row = progress.import_watermarks(spark, str(path)).first()
    assert row["datastream_key"] == "pvacd-1-dtw" and row["watermark"].hour == 18
    path.write_text("{broken")
    assert progress.import_watermarks(spark, str(path)).count() == 0


def test_import_of_the_json_load_mark(spark, tmp_path):
    path = tmp_path / "t.json"
    assert progress.import_last_load(spark, str(path)) is None
    path.write_text(json.dumps({"last_load_id": 1781192390.555875}))
    assert progress.import_last_load(spark, str(path)) == 1781192390.555875
    path.write_text("{broken")
    with pytest.raises(ValueError):
        progress.import_last_load(spark, str(path))


def test_import_of_json_checkpoints(spark, tmp_path):
    path = tmp_path / "c.json"
    assert progress.import_chunks(spark, str(path)).count() == 0
    path.write_text(json.dumps({"completed_chunks": ["a", "b"]}))
    assert progress.import_chunks(spark, str(path)).count() == 2
    path.write_text("nope")
    assert progress.import_chunks(spark, str(path)).count() == 0


def test_a_thousand_commits_leave_few_folders(spark, tmp_path, monkeypatch):
    root = tmp_path / "s"
    monkeypatch.setattr(progress, "FOLD", 5)
    for n in range(1, 41):
        assert progress.commit_state(spark, str(root), state(
            spark, ("x", "load", "last", n), ("x", "chunk", f"k{n}", 1))) == n
        assert len(list(root.iterdir())) <= 3 * progress.FOLD
    assert held(spark, str(root)) == {("load", "last"): 40} | {
        ("chunk", f"k{n}"): 1 for n in range(1, 41)}
    assert progress.latest_snapshot(spark, str(root)) == 40


def test_a_read_that_began_before_a_fold_finds_its_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    monkeypatch.setattr(progress, "FOLD", 4)
    for n in range(1, 7):
        progress.commit_state(spark, root, state(spark, ("x", "load", "last", n)))
    before = progress.read_state(spark, root)  # listed now, read after the next fold
    for n in range(7, 12):
        progress.commit_state(spark, root, state(spark, ("x", "load", "last", n)))
    assert before.first()["position"] == 6
    assert progress.last_number(progress.read_state(spark, root), "x") == 11


def test_a_late_commit_of_an_old_number_is_not_lost(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    monkeypatch.setattr(progress, "FOLD", 3)
    for n in range(1, 5):
        progress.commit_state(spark, root, state(spark, ("x", "load", "last", n)))
    # Another writer took its number before the fold and finished after it.
    progress.commit_state(spark, root, state(spark, ("x", "chunk", "late", 1)), snapshot=1)
    for n in range(5, 20):
        progress.commit_state(spark, root, state(spark, ("x", "load", "last", n)))
    assert held(spark, root) == {("load", "last"): 19, ("chunk", "late"): 1}
