"""The three jobs over an invented landing folder."""

import datetime
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityloom.__main__ import main, parser
from cityloom import session
from cityloom.operators import indicators as ind
from cityloom.operators.learn import PriceModel, restore_model, split_rows
from cityloom.plans import formatting, indicators, training
from cityloom.sources.zones import Zone

D = datetime.date


def put(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines]
    path.write_text("\n".join(text) + "\n", encoding="utf-8")


def listing(code, neighborhood, price, district="Eixample", **more):
    return {
        "propertyCode": code, "country": "es", "municipality": "Barcelona", "province": "Barcelona", "url": "u",
        "thumbnail": "t", "operation": "sale", "district": district, "neighborhood": neighborhood, "price": price,
        "priceByArea": price / 100, "parkingSpace": {"hasParkingSpace": True}, "detailedType": {"typology": "flat"},
        "suggestedTexts": {"title": "Flat"}, **more,
    }


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    put(root / "lookups" / "income_d.json", [
        {"_id": "1", "district": "Eixample", "district_name": "eixample", "district_reconciled": "Eixample"},
        {"_id": "2", "district": "Sarrià-Sant Gervasi", "district_name": "sarria sant gervasi", "district_reconciled": "Sarrià-Sant Gervasi"},
    ])
    put(root / "lookups" / "income_n.json", [
        {"_id": "1", "neighborhood": "la Nova Esquerra de l'Eixample", "neighborhood_name": "la nova esquerra de l eixample", "neighborhood_reconciled": "La Nova Esquerra de l'Eixample"},
        {"_id": "2", "neighborhood": "Sant Antoni", "neighborhood_name": "sant antoni", "neighborhood_reconciled": "Sant Antoni"},
        {"_id": "3", "neighborhood": "Sarrià", "neighborhood_name": "sarria", "neighborhood_reconciled": "Sarrià"},
    ])
    put(root / "lookups" / "rent_d.json", [{"di": "Eixample", "di_re": "Eixample"}, {"di": "Sarrià", "di_re": "Sarrià-Sant Gervasi"}])
    put(root / "lookups" / "rent_n.json", [{"ne": "Sant Antoni", "ne_re": "Sant Antoni"}, {"ne": "Sarrià", "ne_re": "Sarrià"}])

    head = "_id,Estacio,Codi_districte,Nom_districte,Codi_barri,Nom_barri,Codi_Contaminant"
    for year, first in (("2020", 1), ("2021", 2)):
        put(root / "air" / f"{year}_stations.csv", [
            head,
            f"{first},50,2,Eixample,9,Sant Antoni,8",
            f"{first + 10},50,2,Eixample,9,Sant Antoni,10",
            # The same row but for its number.
            f"{first + 20},50,2,Eixample,9,Sant Antoni,10",
            f"{first + 30},51,5,Sarria-Sant Gervasi,23,Sarrià,8",
            f"{first + 40},52,2,Eixample,8,la Nova Esquerra de l'Eixample,7",
            f"{first + 50},53,5,Sarria-Sant Gervasi,23,Sarrià,n/a",
        ])
    put(root / "income" / "a.json", [
        {"_id": "x1", "district_id": "2", "district_name": "Eixample", "neigh_name ": "Sant Antoni",
         "info": [{"year": 2017, "pop": 38182, "RFD": 104.2}, {"year": 2018, "pop": 1, "RFD": 1.0}]},
        {"_id": "x2", "district_id": "2", "district_name": "Eixample", "neigh_name ": "Sant Antoni",
         "info": [{"year": 2017, "pop": 38182, "RFD": 104.2}]},
        {"_id": "x3", "district_id": "5", "district_name": "Sarrià-Sant Gervasi", "neigh_name ": "Sarrià", "info": [{"year": 2017, "pop": 25000, "RFD": 195.5}]},
    ])
    put(root / "income" / "b.json", [
        {"_id": "x4", "district_name": "Nowhere", "neigh_name ": "Nowhere", "info": []},
        {"_id": "x5", "district_name": "Eixample", "neigh_name ": None, "info": None},
    ])

    def day(folder, *files):
        for i, lines in enumerate(files):
            put(root / "listings" / folder / f"part{i}.json", lines)

    many = [listing(f"c{i}", "Sant Antoni" if i % 3 else "Sarrià", 100000.0 + 1000 * i + (i % 7) * 500, size=40 + i) for i in range(60)]
    day("2020_05_04_x", many[:20] + [many[0]], [listing("q1", None, 5.0, district=None, size=1)])
    day("2021_02_10_x", many[20:40])
    day("2021_03_01_x", many[40:60], [listing("q2", "Unknown", 7.0, size=2)])
    lacking = listing("q3", "Sarrià", 9.0, size=3)
    del lacking["suggestedTexts"]
    day("2021_03_02_x", [lacking])
    put(root / "listings" / "stray.json", [listing("no", "Sarrià", 1.0)])
    look = root / "lookups"
    return formatting.Landing(
        *(str(p) for p in (root / "listings", root / "income", root / "air", look / "income_d.json", look / "income_n.json", look / "rent_d.json", look / "rent_n.json"))
    )


@pytest.fixture(scope="module")
def formatted(spark, landing, tmp_path_factory):
    zone = Zone(spark, str(tmp_path_factory.mktemp("formatted")))
    formatting.run(spark, landing, zone)
    return zone


def test_air_quality(formatted):
    air = formatted.read("air_quality")
    assert set(air.columns) == {"Estacio", "Codi_Contaminant", "year", "district", "neighborhood"}
    assert rows(air, "year", "neighborhood", "district", "Codi_Contaminant") == sorted(
        [
            t for y in ("2020", "2021") for t in (
                (y, "Sant Antoni", "Eixample", "8"), (y, "Sant Antoni", "Eixample", "10"),
                (y, "Sarrià", "Sarrià-Sant Gervasi", "8"), (y, "Sarrià", "Sarrià-Sant Gervasi", "n/a"), (y, None, "Eixample", "7"),
            )
        ],
        key=lambda t: [(v is None, str(v)) for v in t],
    )


def test_income(formatted):
    income = formatted.read("income")
    assert set(income.columns) == {"district", "neighborhood", "RFD", "pop", "year"}
    assert rows(income, "neighborhood", "district", "RFD", "pop", "year") == [
        ("Sant Antoni", "Eixample", 104.2, 38182, 2017), ("Sarrià", "Sarrià-Sant Gervasi", 195.5, 25000, 2017),
        (None, "Eixample", None, None, None), (None, None, None, None, None),
    ]


def test_listings(formatted):
    listings = formatted.read("listings")
    assert {"hasParkingSpace", "typology", "title", "date", "district", "neighborhood", "operation"} <= set(listings.columns)
    assert not {"country", "url", "parkingSpace", "source_entry"} & set(listings.columns)
    assert listings.count() == 60 + 3
    assert dict(listings.dtypes)["date"] == "date"
    by_code = {r.propertyCode: r for r in listings.collect()}
    assert by_code["q3"].title is None and by_code["q3"].date == D(2021, 3, 2)
    assert by_code["q2"].neighborhood is None and by_code["q1"].district is None
    assert "no" not in by_code


def test_listing_choices(spark, landing, tmp_path):
    zone = Zone(spark, str(tmp_path))
    choices = formatting.Choices(on_missing="drop", strict_names=True, listings_by="date")
    formatting.run(spark, landing, zone, choices)
    listings = zone.read("listings")
    # The only file without the titles is left out with its single row.
    assert listings.count() == 62 and listings.where("propertyCode = 'q3'").isEmpty()
    assert list((tmp_path / "listings").rglob("date=2021-02-10"))
    assert zone.read("air_quality").where("neighborhood = \"La Nova Esquerra de l'Eixample\"").count() == 2


def test_key_of_another_type_in_one_file(spark, tmp_path):
    put(tmp_path / "a.json", [{"district_name": "7", "neigh_name ": "n", "info": [{"RFD": 1.5, "pop": 2, "year": 2017}]}])
    put(tmp_path / "b.json", [{"district_name": 7, "neigh_name ": "n", "info": [{"RFD": 1.5, "pop": 3, "year": 2017}]}])
    districts = spark.sql("SELECT '7' AS district, 'Seven' AS district_reconciled")
    areas = spark.sql("SELECT 'n' AS neighborhood, 'N' AS neighborhood_reconciled")

    def run(**choices):
        choices = formatting.Choices(**choices)
        frames = formatting.landing_frames(spark, str(tmp_path), by_schema=choices.by_schema)
        return rows(formatting.format_income(frames, districts, areas, choices), "pop", "district", "neighborhood")

    assert run() == [(2, "Seven", "N"), (3, "Seven", "N")]
    assert run(on_mismatch="null") == [(2, "Seven", "N"), (3, None, "N")]


def test_declared_schemas_give_the_same(spark, landing, formatted, tmp_path):
    from dataclasses import replace

    struct = "parkingSpace struct<hasParkingSpace:boolean>, detailedType struct<typology:string>, suggestedTexts struct<title:string>"
    declared = replace(
        landing,
        listings_schema=f"propertyCode string, operation string, district string, neighborhood string, price double, priceByArea double, size bigint, {struct}",
        income_schema="_id string, district_id string, district_name string, `neigh_name ` string, info array<struct<RFD:double,pop:bigint,year:bigint>>",
        air_quality_schema="_id string, Estacio string, Codi_districte string, Nom_districte string, Codi_barri string, Nom_barri string, Codi_Contaminant string",
    )
    zone = Zone(spark, str(tmp_path))
    formatting.run(spark, declared, zone)
    for name in ("listings", "income", "air_quality"):
        there = formatted.read(name)
        assert rows(zone.read(name).select(*there.columns)) == rows(there)


def test_incremental_listings_and_near_names(spark, landing, formatted, tmp_path):
    zone = Zone(spark, str(tmp_path))
    choices = formatting.Choices(near_names=1)
    for _ in range(2):
        formatting.run(spark, landing, zone, choices, incremental=True)
        there = formatted.read("listings")
        assert rows(zone.read("listings").select(*there.columns)) == rows(there)
    assert len(zone.runs("listings")) == 1
    # An apostrophe is one letter.
    assert zone.read("air_quality").where("neighborhood = \"La Nova Esquerra de l'Eixample\"").count() == 2


def test_kpi_job_twice(spark, formatted, tmp_path):
    zone = Zone(spark, str(tmp_path))
    indicators.run(formatted, zone)
    listings, income, air = (formatted.read(n) for n in ("listings", "income", "air_quality"))
    values = dict(rows(zone.read("kpis"), "KPI", "Value"))
    assert values["average_listings_per_day"] == pytest.approx(63 / 4)
    naive = listings.select("neighborhood", "price").join(income.select("neighborhood", "RFD"), "neighborhood").stat.corr("price", "RFD")
    assert values["correlation_price_RFD"] == pytest.approx(naive)
    pairs = air.join(
        listings.select("neighborhood", F.year("date").cast("string").alias("year"), "price"), ["neighborhood", "year"]
    ).withColumn("code", F.col("Codi_Contaminant").try_cast("double"))
    assert values["correlation_price_contaminants"] == pytest.approx(ind.correlation(pairs, "price", "code").first()[0])
    assert [tuple(r) for r in zone.read("top_sellers").orderBy(F.desc("count"), F.asc_nulls_last("neighborhood")).collect()] == [("Sant Antoni", 14), ("Sarrià", 7), (None, 1)]
    assert dict(rows(zone.read("top_air_quality"))) == {"Sant Antoni": 4, "Sarrià": 4, None: 2}

    indicators.run(formatted, zone)
    assert zone.read("kpis").count() == 3
    indicators.run(formatted, zone, mode="append")
    assert zone.read("kpis").count() == 6
    zero = Zone(spark, str(tmp_path / "zero"))
    indicators.run(formatted, zero, nulls="zero")
    filled = pairs.withColumn("code", F.coalesce("code", F.lit(0.0))).stat.corr("price", "code")
    assert dict(rows(zero.read("kpis")))["correlation_price_contaminants"] == pytest.approx(filled)


def test_training_job(spark, formatted, tmp_path):
    zone = Zone(spark, str(tmp_path))
    model, metrics = training.run(formatted, zone)
    listings, income, air = (formatted.read(n) for n in ("listings", "income", "air_quality"))
    frame = zone.read("model_frame")
    left = air.select("neighborhood", F.col("year").cast("int").alias("year"), "Codi_Contaminant")
    expected = left.join(listings.withColumn("year", F.year("date")), ["neighborhood", "year"]).join(income.select("neighborhood"), "neighborhood")
    assert frame.count() == expected.count() > 50
    # The title is missing in one listing, so its column goes; so does the price by area.
    assert {"price", "date", "year", "neighborhood", "RFD", "pop", "district"} <= set(frame.columns)
    assert not {"title", "priceByArea", "_id"} & set(frame.columns)
    # Both sides have a district and a year; the sensor rows' copies stay.
    assert dict(frame.dtypes)["year"] == "string"
    again = PriceModel.load(spark, zone.path("price_model"))
    assert again.predict(frame).select(F.sum("prediction")).first()[0] == pytest.approx(model.predict(frame).select(F.sum("prediction")).first()[0])
    assert not zone.read("price_model_archive").isEmpty()
    assert zone.read("price_model_metrics").first().r2 == metrics.first().r2


def test_training_runs_are_told_apart(spark, formatted, tmp_path):
    zone = Zone(spark, str(tmp_path))
    frames = []
    for _ in range(2):
        model, _ = training.run(formatted, zone, mode="append", split_key="propertyCode")
        frames.append(zone.read("model_frame").groupBy("run").count())
    sizes = rows(frames[-1], "count")
    assert len(sizes) == 2 and sizes[0] == sizes[1]
    assert zone.read("price_model_metrics").select("run").distinct().count() == 2
    run = frames[-1].orderBy("run").first().run
    again = restore_model(spark, zone.read("price_model_archive"), zone.read("price_model_labels"), run, str(tmp_path / "again"))
    frame = zone.read("model_frame").where(F.col("run") == run)
    assert again.predict(frame).select(F.count("prediction")).first()[0] == frame.count()
    # All joined rows of a listing are on one side of the split.
    train, test = split_rows(zone.read("model_frame").drop("run"), key="propertyCode")
    assert train.join(test, "propertyCode", "left_semi").isEmpty()


def test_training_reads_its_own_run_alone(spark, formatted, tmp_path, monkeypatch):
    zone, read = Zone(spark, str(tmp_path)), []
    fit = training.fit_price_model
    monkeypatch.setattr(training, "fit_price_model", lambda df, **options: read.append(df.inputFiles()) or fit(df, **options))
    for _ in range(2):
        training.run(formatted, zone, mode="append")
    runs = zone.runs("model_frame")
    assert len(runs) == 2 and all(files and all(run in file for file in files) for run, files in zip(runs, read, strict=True))


def test_nothing_to_train_on(spark, formatted, tmp_path):
    empty = Zone(spark, str(tmp_path / "in"))
    for name in ("listings", "income", "air_quality"):
        empty.write(name, formatted.read(name).limit(0))
    with pytest.raises(ValueError, match="nothing to train"):
        training.run(empty, Zone(spark, str(tmp_path / "out")))


def test_jobs_fail_loudly(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist"):
        indicators.run(Zone(spark, str(tmp_path / "none")), Zone(spark, str(tmp_path / "out")))


def test_command_line_runs_jobs_and_clears_up(spark, formatted, tmp_path, caplog):
    caplog.set_level("INFO")
    main(["kpi", "--formatted", formatted.root, "--exploitation", str(tmp_path), "--describe"])
    zone = Zone(spark, str(tmp_path))
    assert zone.read("kpis").count() == 3
    assert "kpis: 3 rows, 2 columns, struct<KPI:string,Value:double>" in caplog.text
    main(["kpi", "--formatted", formatted.root, "--exploitation", str(tmp_path), "--mode", "append"])
    main(["dashboard", "--exploitation", str(tmp_path), "--exclude-seller", "Sarrià"])
    assert zone.read("kpis").count() == 6 and zone.read("dashboard_kpis").count() == 3
    assert rows(zone.read("dashboard_top_sellers"), "neighborhood", "count") == [("Sant Antoni", 14), (None, 1)]
    assert rows(zone.read("dashboard_top_air_quality"), "neighborhood", "count") == [("Sant Antoni", 4), ("Sarrià", 4)]
    files, root = session.hadoop_path(spark, session._scratch_root(spark))
    assert not files.exists(root)


def test_command_line_trains_without_a_frame(spark, formatted, tmp_path):
    main(["train", "--formatted", formatted.root, "--exploitation", str(tmp_path), "--split-key", "propertyCode", "--no-frame", "--folds", "2"])
    zone = Zone(spark, str(tmp_path))
    assert zone.read("price_model_folds").count() == 2 and zone.exists("price_model_coefficients") and not zone.exists("model_frame")


def test_command_line():
    paths = [x for name in ("listings", "income", "air-quality", "income-districts", "income-neighborhoods", "listing-districts", "listing-neighborhoods") for x in (f"--{name}", "p")]
    args = parser().parse_args(["format", *paths, "--formatted", "f", "--listings-schema", "a int"])
    assert args.listings_schema == "a int" and args.income_schema is None
    assert parser().parse_args(["kpi", "--formatted", "f", "--exploitation", "e", "--nulls", "zero"]).nulls == "zero"
    with pytest.raises(SystemExit):
        parser().parse_args(["other"])
