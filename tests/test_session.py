from pathlib import Path

from conftest import rows

from cityloom import session


def test_scratch_lies_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(named)
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_staged_rows_come_from_files(spark):
    df = session.stage(spark.range(5), "five")
    assert rows(df) == [(i,) for i in range(5)]
    assert all("/five-" in name for name in df.inputFiles())
    root = Path(session._scratch_root(spark))
    assert root.exists()
    session.clear_scratch(spark)
    assert not root.exists()


def test_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    with session.sized_for(spark, path) as small:
        assert sorted(small.values()) == [4, 128 << 20, 128 << 20]
        before = {key: spark.conf.get(key) for key in small}
        monkeypatch.setattr(session, "MB_128", 1000)
        monkeypatch.setattr(session, "MAX_SCAN_TASKS", 2)
        with session.sized_for(spark, path) as large:
            scan, shuffle, piece = large.values()
            assert scan > 1000 and shuffle > 4 and piece == 2000
            assert {key: spark.conf.get(key) for key in large} == {key: str(size) for key, size in large.items()}
        assert {key: spark.conf.get(key) for key in small} == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
