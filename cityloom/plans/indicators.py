"""Indicators job: formatted zone to KPI and top tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityloom.operators import indicators as ind
from cityloom.session import sized_for, stage
from cityloom.sources.zones import Zone

# Table and KPI names read by the dashboard queries.
KPI_TABLE = "kpis"
TOP_SELLERS_TABLE = "top_sellers"
TOP_AIR_TABLE = "top_air_quality"
MEAN_LISTINGS = "average_listings_per_day"
PRICE_INCOME = "correlation_price_RFD"
PRICE_AIR = "correlation_price_contaminants"
# What an incremental run keeps for the next one.
STATE_TABLE = "kpi_state"
PRICE_MOMENTS = ("price_n", "price_mean", "price_dev", "price_min", "price_max")
STATE_COLUMNS = ("kind", "neighborhood", "date", "year", "n_rows", *PRICE_MOMENTS)


def listing_cube(listings: DataFrame, nulls: str = "skip") -> DataFrame:
    """Listings per neighborhood and date with the moments of the price.

    All indicators on listings follow from it, so the listings are scanned once and what is
    shuffled is one row per task, neighborhood and date.
    """
    price = F.col("price").cast("double")
    if nulls == "zero":
        price = F.coalesce(price, F.lit(0.0))
    return listings.groupBy("neighborhood", "date").agg(F.count("*").alias("n_rows"), *ind.moment_columns(price, "price"))


def mean_listings_per_day(cube: DataFrame) -> DataFrame:
    per_day = cube.groupBy("date").agg(F.sum("n_rows").alias("n_rows"))
    return per_day.agg(F.avg("n_rows").alias("value"))


def latest_top_sellers(cube: DataFrame, n: int = 5) -> DataFrame:
    counts = ind.in_latest_month(cube).groupBy("neighborhood").agg(F.sum("n_rows").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("neighborhood")).limit(n)


def _price_income(price: DataFrame, income: DataFrame) -> DataFrame:
    """Listings and income meet on the neighborhood."""
    return ind.correlation_of_moments(price, "price", income, "income", ["neighborhood"])


def _price_air(price: DataFrame, air: DataFrame) -> DataFrame:
    """Listings and sensor rows meet on neighborhood and year; the contaminant code is taken as a number."""
    return ind.correlation_of_moments(price, "price", air, "air", ["neighborhood", "year"])


def price_income_correlation(cube: DataFrame, income: DataFrame, nulls: str = "skip") -> DataFrame:
    keys = ["neighborhood"]
    return _price_income(ind.merge_moments(cube, keys, "price"), ind.moments(income, keys, "RFD", "income", nulls))


def price_by_year(cube: DataFrame) -> DataFrame:
    """Moments of the price per neighborhood and year."""
    return ind.merge_moments(cube.withColumn("year", F.year("date")), ["neighborhood", "year"], "price")


def _kpis(mean: DataFrame, prices: DataFrame, income: DataFrame, air: DataFrame, nulls: str) -> DataFrame:
    """The KPIs from the mean of the daily counts and the price's moments per neighborhood and year.

    The moments are written once: each of the means that correlations are centred on is one more look at them.
    """
    prices = stage(prices, "price-moments")
    coded = air.select("neighborhood", F.col("year").try_cast("int").alias("year"), F.col("Codi_Contaminant").try_cast("double").alias("code"))
    income = stage(ind.moments(income, ["neighborhood"], "RFD", "income", nulls), "income-moments")
    air = stage(ind.moments(coded, ["neighborhood", "year"], "code", "air", nulls), "air-moments")
    by_area = ind.merge_moments(prices, ["neighborhood"], "price")
    return ind.kpi_rows({MEAN_LISTINGS: mean, PRICE_INCOME: _price_income(by_area, income), PRICE_AIR: _price_air(prices, air)})


def kpis(cube: DataFrame, income: DataFrame, air: DataFrame, nulls: str = "skip") -> DataFrame:
    return _kpis(mean_listings_per_day(cube), price_by_year(cube), income, air, nulls)


def run(formatted: Zone, exploitation: Zone, mode: str = "overwrite", nulls: str = "skip", incremental: bool = False) -> None:
    """Write the KPI table and the two top-5 tables; ``mode='append'`` keeps those of earlier runs.

    ``incremental`` reads only the listings that were written since the last such run, and merges what they add into the state that it left.
    """
    with sized_for(formatted.spark, formatted.root):
        income, air = (formatted.read(name) for name in ("income", "air_quality"))
        if incremental:
            state = up_to_date(formatted, exploitation, nulls)
            found, sellers = kpis_of_state(state, income, air, nulls), top_sellers_of_state(state)
        else:
            cube = stage(listing_cube(formatted.read("listings"), nulls), "listing-cube")
            found, sellers = kpis(cube, income, air, nulls), latest_top_sellers(cube)
        exploitation.write(KPI_TABLE, found, mode)
        exploitation.write(TOP_SELLERS_TABLE, sellers, mode)
        exploitation.write(TOP_AIR_TABLE, ind.top_groups(air, "neighborhood"), mode)


def listing_state(listings: DataFrame, nulls: str = "skip") -> DataFrame:
    """What all listing indicators follow from, in a form that can be merged: rows of three kinds.

    ``day``: listings of a date; ``price``: moments of the price of a neighborhood and year; ``month``: listings of a neighborhood in the latest month, whose
    first day is the date. As many rows as dates, neighborhoods times years, and neighborhoods.
    """
    cube = stage(listing_cube(listings, nulls), "listing-cube")
    days = cube.groupBy("date").agg(F.sum("n_rows").alias("n_rows"))
    month = F.trunc("date", "month").alias("date")
    months = ind.in_latest_month(cube).select("neighborhood", month, "n_rows").groupBy("neighborhood", "date").agg(F.sum("n_rows").alias("n_rows"))
    return _state_rows(days, price_by_year(cube), months)


def _state_rows(days: DataFrame, prices: DataFrame, months: DataFrame) -> DataFrame:
    kinds = {"day": days, "price": prices, "month": months}
    frames = [rows.select(F.lit(kind).alias("kind"), "*") for kind, rows in kinds.items()]
    united = frames[0].unionByName(frames[2], allowMissingColumns=True).unionByName(frames[1], allowMissingColumns=True)
    return united.select(*STATE_COLUMNS)


def merged_state(first: DataFrame, second: DataFrame) -> DataFrame:
    """The state of the rows of both; months before the latest are out of date and dropped."""
    both = stage(first.unionByName(second), "kpi-states")
    days = both.where("kind = 'day'").groupBy("date").agg(F.sum("n_rows").alias("n_rows"))
    prices = ind.merge_moments(both.where("kind = 'price'"), ["neighborhood", "year"], "price")
    months = both.where("kind = 'month'")
    latest = months.where(F.col("date") == months.select(F.max("date")).scalar())
    return _state_rows(days, prices, latest.groupBy("neighborhood", "date").agg(F.sum("n_rows").alias("n_rows")))


def kpis_of_state(state: DataFrame, income: DataFrame, air: DataFrame, nulls: str = "skip") -> DataFrame:
    mean = state.where("kind = 'day'").agg(F.avg("n_rows").alias("value"))
    return _kpis(mean, state.where("kind = 'price'").select("neighborhood", "year", *PRICE_MOMENTS), income, air, nulls)


def top_sellers_of_state(state: DataFrame, n: int = 5) -> DataFrame:
    counts = state.where("kind = 'month'").select("neighborhood", F.col("n_rows").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("neighborhood")).limit(n)


def up_to_date(formatted: Zone, exploitation: Zone, nulls: str = "skip") -> DataFrame:
    """The state of all listings: that of the last run with what was written since, or a new one where listings were replaced meanwhile or NULLs counted otherwise."""
    there = list(formatted.runs("listings"))
    noted = exploitation.notes(STATE_TABLE) if exploitation.exists(STATE_TABLE) else {}
    done = noted.get("listing_runs", [])
    # Files of other programs have no runs that could be told apart.
    grown = bool(done) and noted.get("nulls") == nulls and set(done) <= set(there) and all(run != "." for run in there)
    if not grown:
        state = listing_state(formatted.read("listings"), nulls)
    elif len(done) == len(there):
        return exploitation.read(STATE_TABLE)
    else:
        added = formatted.read("listings", runs=set(there) - set(done))
        state = merged_state(exploitation.read(STATE_TABLE), listing_state(added, nulls))
    exploitation.write(STATE_TABLE, state, "overwrite", notes={"listing_runs": there, "nulls": nulls})
    return exploitation.read(STATE_TABLE)
