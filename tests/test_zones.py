import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityloom.sources import zones
from cityloom.sources.zones import RUNS, Zone


@pytest.fixture
def zone(spark, tmp_path):
    return Zone(spark, str(tmp_path))


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def files_of(tmp_path, table):
    return sorted(p.name for p in (tmp_path / table / RUNS).iterdir())


def failing(spark):
    return numbers(spark, 1, 2).withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("midway")).cast("int")).otherwise(F.col("v")))


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_write_that_fails_changes_nothing(spark, zone, tmp_path, mode):
    zone.write("t", numbers(spark, 7))
    before = files_of(tmp_path, "t")
    with pytest.raises(Exception, match="midway"):
        zone.write("t", failing(spark), mode)
    assert rows(zone.read("t")) == [(7,)] and files_of(tmp_path, "t") == before
    with pytest.raises(Exception, match="midway"):
        zone.write("new", failing(spark))
    assert not zone.exists("new")


def test_a_job_that_ends_before_the_pointer_leaves_the_table(spark, zone, monkeypatch):
    zone.write("t", numbers(spark, 7))
    monkeypatch.setattr(Zone, "_commit", lambda *_: (_ for _ in ()).throw(SystemExit()))
    with pytest.raises(SystemExit):
        zone.write("t", numbers(spark, 8).withColumn("more", F.lit(1)), "overwrite")
    monkeypatch.undo()
    assert rows(zone.read("t")) == [(7,)]


def test_replaced_rows_are_deleted_and_may_come_from_the_table(spark, zone, tmp_path):
    zone.write("t", numbers(spark, 1, 2))
    zone.write("t", numbers(spark, 3))
    zone.write("t", zone.read("t").where("v > 1"), "overwrite")
    zone.write("t", zone.read("t").union(zone.read("t")))
    assert rows(zone.read("t")) == [(2,)] * 3 + [(3,)] * 3
    assert len(zone.runs("t")) == 2 == len(files_of(tmp_path, "t"))
    assert len(list((tmp_path / "t").glob("_pointer-*"))) == 1 and not list((tmp_path / "t").glob("_draft-*"))


def test_another_writer_is_not_overwritten(spark, zone):
    zone.write("t", numbers(spark, 1))
    plain = Zone._with_run

    def slow(pointer, run, *rest):
        # While this writer is about to end, another one ends: once before its pointer is made, so that its number is taken.
        if run == "slow" and pointer.number == 1:
            zone.write("t", numbers(spark, 2).withColumn("w", F.lit("x")), run="quick")
            zone.write("t", numbers(spark, 4), run="quicker")
        return plain(pointer, run, *rest)

    Zone._with_run = staticmethod(slow)
    try:
        zone.write("t", numbers(spark, 3), run="slow")
    finally:
        Zone._with_run = staticmethod(plain)
    assert zone.read("t").columns == ["v", "w"]
    assert sorted(r.v for r in zone.read("t").collect()) == [1, 2, 3, 4]
    assert zone.runs("t")[1:] == ("quick", "quicker", "slow")


def test_runs_notes_and_tables_beside(spark, zone):
    zone.write("t", numbers(spark, 1), notes={"a": 1, "b": [1]}, beside={"files": numbers(spark, 10)})
    zone.write("t", numbers(spark, 2), notes={"a": 2})
    zone.write("t", numbers(spark, 3), beside={"files": numbers(spark, 30)})
    first, second, _ = zone.runs("t")
    assert zone.notes("t") == {"a": 2, "b": [1]}
    assert rows(zone.read("t", runs=[second])) == [(2,)] and rows(zone.read("t", runs=[])) == []
    assert rows(zone.read_beside("t", "files")) == [(10,), (30,)] and zone.read_beside("t", "other") is None
    zone.write("t", numbers(spark, 4), "overwrite")
    assert zone.read_beside("t", "files") is None and zone.notes("t") == {} and zone.runs("none") == ()


def test_partitions_are_the_same_in_all_runs(spark, zone):
    coded = numbers(spark, 1, 2).withColumn("code", F.lpad(F.col("v").cast("string"), 2, "0"))
    for _ in range(2):
        zone.write("t", coded, partition_by="code")
    assert rows(zone.read("t"), "v", "code") == [(1, "01"), (1, "01"), (2, "02"), (2, "02")]
    with pytest.raises(ValueError, match="partitioned by code"):
        zone.write("t", coded)


def test_files_of_other_programs_are_replaced(spark, zone, tmp_path):
    numbers(spark, 1).write.parquet(str(tmp_path / "t"))
    assert zone.exists("t") and zone.runs("t") == (".",)
    zone.write("t", numbers(spark, 2))
    assert rows(zone.read("t")) == [(1,), (2,)] and rows(zone.read("t", runs=["."])) == [(1,)]
    zone.write("t", numbers(spark, 3), "overwrite")
    assert rows(zone.read("t")) == [(3,)] and not list((tmp_path / "t").glob("*.parquet"))


def test_views(spark, zone):
    zone.write("t", numbers(spark, 1, 2))
    zone.as_views("t", prefix="own_")
    assert spark.sql("SELECT sum(v) AS s FROM own_t").first().s == 3


def test_files_have_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "FILE_ROWS", 10)
    zone = Zone(spark, str(tmp_path))
    zone.write("t", spark.range(95, numPartitions=1))
    assert len(zone.read("t").inputFiles()) == 10 and zone.read("t").count() == 95
