import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityloom.operators.conform import conform_union
from cityloom.sources.landing import SOURCE, landing_frames, with_day, with_year
from cityloom.sources.zones import Zone, preview


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_formats_are_chosen_by_extension_and_others_skipped(spark, tmp_path):
    put(tmp_path / "2019_a.csv", "k,v\n1,x\n2,\n")
    put(tmp_path / "2020_b.json", '{"k": 3, "tags": ["p", "q"]}\n{"k": 4}\n')
    spark.createDataFrame([(5, "z")], "k int, v string").coalesce(1).write.parquet(str(tmp_path / "2021_c.parquet"))
    put(tmp_path / "readme.txt", "k,v\n9,9\n")
    put(tmp_path / "notes.csv.bak", "k,v\n9,9\n")
    df = with_year(conform_union(landing_frames(spark, str(tmp_path))))
    assert rows(df, "k", "v", "year") == [
        ("1", "x", "2019"), ("2", None, "2019"), ("3", None, "2020"), ("4", None, "2020"), ("5", "z", "2021"),
    ]
    assert df.where("k = '3'").first()["tags"] == ["p", "q"]


def test_csv_values_stay_text_and_quoted_commas_hold(spark, tmp_path):
    put(tmp_path / "a.csv", '_id,code,name\r\n1,007,"Sant Pere, Santa Caterina"\r\n')
    (frame,) = landing_frames(spark, str(tmp_path))
    assert tuple(frame.drop(SOURCE).first()) == ("1", "007", "Sant Pere, Santa Caterina")


def test_csv_files_with_other_headers_are_not_mixed_up(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,x\n20,10\n")
    put(tmp_path / "c.csv", "x,y\n3,4\n")
    put(tmp_path / "empty.csv", "")
    frames = landing_frames(spark, str(tmp_path))
    assert len(frames) == 2
    assert rows(conform_union(frames), "x", "y") == [("1", "2"), ("10", "20"), ("3", "4")]


def test_declared_schema_checks_the_header(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,x\n20,10\n")
    (frame,) = landing_frames(spark, str(tmp_path), schema="x string, y string")
    with pytest.raises(Exception, match="CSV header does not conform"):
        frame.collect()


def test_json_types_that_differ_between_files_become_text(spark, tmp_path):
    put(tmp_path / "a.json", '{"k": 1}\n')
    put(tmp_path / "b.json", '{"k": "one"}\n')
    assert rows(conform_union(landing_frames(spark, str(tmp_path))), "k") == [("1",), ("one",)]
    assert len(landing_frames(spark, str(tmp_path), by_schema=True)) == 2


def test_parquet_types_that_differ_between_files_become_text(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([("one", 2.5)], "k string, w double").write.parquet(str(tmp_path / "b.parquet"))
    df = conform_union(landing_frames(spark, str(tmp_path)))
    assert rows(df, "k", "v", "w") == [("1", "a", None), ("one", None, 2.5)]


def test_daily_folders(spark, tmp_path):
    put(tmp_path / "2021_03_01_x" / "a.json", '{"k": 1}\n')
    put(tmp_path / "2021_03_01_x" / "b.json", '{"k": 2}\n')
    put(tmp_path / "2021_03_02 y+z" / "a.json", '{"k": 3}\n')
    put(tmp_path / "no_date" / "a.json", '{"k": 4}\n')
    put(tmp_path / "2021_03_03.json", '{"k": 99}\n')
    put(tmp_path / "2021_03_05 {odd} [x]%20" / "a.csv", "k\n5\n")
    (tmp_path / "2021_03_04_empty").mkdir()
    df = with_day(conform_union(landing_frames(spark, str(tmp_path), "daily")))
    assert rows(df, "k", "date") == [
        ("1", datetime.date(2021, 3, 1)), ("2", datetime.date(2021, 3, 1)), ("3", datetime.date(2021, 3, 2)),
        ("4", None), ("5", datetime.date(2021, 3, 5)),
    ]
    assert df.where("k = '3'").first()[SOURCE] == "2021_03_02 y+z"
    assert df.where("k = '5'").first()[SOURCE] == "2021_03_05 {odd} [x]%20"


def test_a_filter_on_the_day_skips_files(spark, tmp_path):
    for day in range(1, 6):
        put(tmp_path / f"2021_03_0{day}" / "a.json", f'{{"k": {day}}}\n')
    df = with_day(conform_union(landing_frames(spark, str(tmp_path), "daily", schema="k int")))
    one_day = df.where(F.col("date") == datetime.date(2021, 3, 4))
    assert [r["k"] for r in one_day.collect()] == [4]
    scan = one_day._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 1


def jobs_of(spark, work):
    """How many Spark jobs a piece of work runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_take_few_jobs(spark, tmp_path):
    for i in range(2000):
        put(tmp_path / f"{i:04d}.csv", f"x,y\n{i},1\n" if i % 2 else f"y,x\n1,{i}\n")
    frames = []
    assert jobs_of(spark, lambda: frames.extend(landing_frames(spark, str(tmp_path)))) < 30
    assert len(frames) == 2
    df = conform_union(frames)
    assert df.agg(F.count("*"), F.sum(F.col("x").cast("int")), F.max("y")).first()[:] == (2000, sum(range(2000)), "1")


def test_many_parquet_files_take_few_jobs(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from cityloom.sources import landing

    for i in range(2000):
        pq.write_table(pa.table({"x": pa.array([i], pa.int64()), "y": ["a"]} if i % 2 else {"x": [str(i)], "z a": [i]}), tmp_path / f"{i:04d} %.parquet")
    frames = []
    assert jobs_of(spark, lambda: frames.extend(landing_frames(spark, str(tmp_path), by_schema=True))) < 60
    assert sorted((frame.count(), tuple(frame.columns[:2])) for frame in frames) == [(1000, ("x", "y")), (1000, ("x", "z a"))]
    # Where tasks cannot reach the files by themselves, the driver asks Spark for each.
    for i in range(3, 2000):
        (tmp_path / f"{i:04d} %.parquet").unlink()
    monkeypatch.setattr(landing, "_footer", lambda name: (_ for _ in ()).throw(OSError("not reached")))
    again = landing_frames(spark, str(tmp_path), by_schema=True)
    assert sorted((frame.count(), tuple(frame.columns[:2])) for frame in again) == [(1, ("x", "y")), (2, ("x", "z a"))]


def test_headers_after_blank_lines(spark, tmp_path):
    put(tmp_path / "a.csv", "\n  \nx,y\n1,2\n")
    put(tmp_path / "b.csv", "x,y\n3,4\n")
    put(tmp_path / "c.csv", "\r\nx,z\r\n5,6\r\n")
    put(tmp_path / "blank.csv", "\n\n")
    frames = landing_frames(spark, str(tmp_path))
    assert rows(conform_union(frames), "x", "y", "z") == [("1", "2", None), ("3", "4", None), ("5", None, "6")]
    (tmp_path / "one").mkdir()
    put(tmp_path / "one" / "a.csv", "\nx,y\n1,2\n")
    assert rows(conform_union(landing_frames(spark, str(tmp_path / "one"))), "x", "y") == [("1", "2")]


def test_a_file_without_a_header_in_its_first_piece_is_an_error(spark, tmp_path):
    put(tmp_path / "a.csv", " \n" * 4000 + "x,y\n1,2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with pytest.raises(ValueError, match="no header at the beginning of .*a.csv"):
            landing_frames(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_more_files_of_a_header_than_a_plan_names(spark, tmp_path, monkeypatch):
    from cityloom.sources import landing

    monkeypatch.setattr(landing, "FEW_FILES", 1)
    for i in range(4):
        put(tmp_path / f"{i}.csv", f"x,y\n{i},a\n")
    put(tmp_path / "9.csv", "y\nb\n")
    put(tmp_path / "8.json", '{"x": 5}\n')
    got = conform_union(landing_frames(spark, str(tmp_path), by_schema=True))
    assert rows(got, "x", "y") == [("0", "a"), ("1", "a"), ("2", "a"), ("3", "a"), ("5", None), (None, "b")]


def test_empty_objects_and_declared_columns(spark, tmp_path):
    put(tmp_path / "a.json", "{}\n{}\n")
    put(tmp_path / "b.json", '{"k": 1, "s": {"v": "x"}, "d": 1.5}\n')
    frames = landing_frames(spark, str(tmp_path), by_schema=True)
    assert sorted(frame.count() for frame in frames) == [1, 2]
    assert rows(conform_union(frames), "k", "d") == [(1, 1.5), (None, None), (None, None)]
    declared = landing_frames(spark, str(tmp_path), schema="k int, s struct<v:string>, other string", by_schema=True)
    assert sorted(tuple(frame.columns) for frame in declared) == [("k", "s", SOURCE), (SOURCE,)]


def test_runs_with_other_columns_or_types(spark, tmp_path):
    zone = Zone(spark, str(tmp_path))
    zone.write("t", spark.sql("SELECT 1 AS a"))
    zone.write("t", spark.sql("SELECT 2 AS a, 'x' AS b"))
    assert rows(zone.read("t"), "a", "b") == [(1, None), (2, "x")]
    with pytest.raises(ValueError, match="other types in: a"):
        zone.write("t", spark.sql("SELECT 'text' AS a"))
    with pytest.raises(Exception, match="empty text"):
        zone.write("p", spark.sql("SELECT '' AS code, 1 AS v"), partition_by="code")


def test_tables_of_other_programs_are_read(spark, tmp_path):
    for i, sql in enumerate(("SELECT 1 AS a", "SELECT 2 AS a, 'x' AS b")):
        spark.sql(sql).write.mode("append").parquet(str(tmp_path / "t"))
    zone = Zone(spark, str(tmp_path))
    assert rows(zone.read("t"), "a", "b") == [(1, None), (2, "x")]
    zone.write("t", spark.sql("SELECT 3 AS a"))
    assert rows(zone.read("t"), "a", "b") == [(1, None), (2, "x"), (3, None)]


def test_nothing_to_read(spark, tmp_path):
    assert landing_frames(spark, str(tmp_path)) == []
    assert conform_union([]) is None


def test_zone_append_replace_and_untyped_columns(spark, tmp_path):
    zone = Zone(spark, str(tmp_path / "zone"))
    df = spark.range(3).withColumn("empty", F.lit(None))
    assert not zone.exists("t")
    zone.write("t", df)
    zone.write("t", df)
    assert zone.exists("t") and zone.read("t").count() == 6
    zone.write("t", df, "overwrite")
    assert zone.read("t").count() == 3
    assert dict(zone.read("t").dtypes)["empty"] == "string"
    assert set(zone.read_all("t")) == {"t"}
    assert zone.drop("t") and not zone.drop("t") and not zone.exists("t")


def test_zone_in_another_format(spark, tmp_path):
    zone = Zone(spark, str(tmp_path / "zone"), "json", {"compression": "gzip"})
    zone.write("t", spark.range(3))
    assert rows(zone.read("t", "id bigint")) == [(0,), (1,), (2,)]


def test_partitioned_table_splits_no_partition_needlessly(spark, tmp_path):
    zone = Zone(spark, str(tmp_path / "zone"))
    df = spark.range(1000).repartition(8).withColumn("p", F.when(F.col("id") < 900, "hot").otherwise("rest"))
    zone.write("t", df, partition_by="p")
    assert zone.read("t").count() == 1000
    assert len(list((tmp_path / "zone" / "t").rglob("*.parquet"))) == 2


def test_preview(spark):
    shown = preview(spark.range(9).withColumnRenamed("id", "k"), "k", rows=2).collect()
    assert [tuple(r) for r in shown] == [(0, "struct<k:bigint>"), (1, "struct<k:bigint>")]


def test_entries_are_looked_for_at_the_end_of_a_path_only(spark):
    from conftest import plan_of

    from cityloom.sources.landing import LAYOUTS, entry_of

    folder = "file:///a=1/b.csv/x.json/in"
    names = ["2020_s.csv", "day=2020_05_04/p.json", "file=2020_s.csv/part-0.csv", "2020_05_04/a.json/part-1.json", "x.csv/y.csv/part-2.csv", "a b+c%20d.parquet", "none.txt", "d=1/e=2.csv"]
    paths = [f"{root}{name}" for name in names for root in (folder + "/", "/", "", "s3://")]
    df = spark.createDataFrame([(path,) for path in paths], "path string")
    for layout, (_, pattern) in LAYOUTS.items():
        whole = F.regexp_extract("path", pattern, 1)
        decoded = F.url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))
        expected = F.when(F.contains(whole, F.lit("%")), decoded).otherwise(whole)
        found = df.select("path", entry_of(F.col("path"), layout).alias("entry"))
        assert found.exceptAll(df.select("path", expected.alias("entry"))).collect() == []
        assert "substring_index" in plan_of(found)
