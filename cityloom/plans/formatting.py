"""Formatting job: landing files to the three tables of the formatted zone."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityloom.functions.text import normalize_name
from cityloom.operators.conform import align_key, conform_union, drop_duplicate_rows
from cityloom.operators.lookup import Level, reconcile
from cityloom.operators.near import add_near_name
from cityloom.operators.shape import first_element, flatten_in_frames
from cityloom.session import sized_for
from cityloom.sources.landing import SOURCE, landing_frames, read_files, with_day, with_year
from cityloom.sources.ledger import fingerprint, load_new
from cityloom.sources.zones import Zone

log = logging.getLogger(__name__)

# Columns of the listing files.
LISTING_STRUCTS = ("parkingSpace", "detailedType", "suggestedTexts")
LISTING_UNUSED = ("country", "municipality", "province", "url", "thumbnail")


@dataclass(frozen=True)
class Landing:
    """Folders of the three data sets, JSON-lines files of the four lookups, and optionally
    the data sets' schemas as DDL: a declared schema saves the pass that infers it."""

    listings: str
    income: str
    air_quality: str
    income_districts: str
    income_neighborhoods: str
    listing_districts: str
    listing_neighborhoods: str
    listings_schema: str | None = None
    income_schema: str | None = None
    air_quality_schema: str | None = None


@dataclass(frozen=True)
class Choices:
    """Behaviour where data sets can be read in two ways.

    ``on_mismatch``: a key of another type than the lookup's is converted ("cast") or blanked ("null").
    ``on_missing``: listing files without one of the struct columns are kept ("keep") or left out ("drop").
    ``strict_names``: also match names differing in apostrophes or surrounding quotes.
    ``listings_by``: partition column of the listings table; the later jobs read whole columns and need
    none, and it costs one more shuffle of all listings.
    ``fields_replace``: a field of a flattened struct takes the place of a column of its name; otherwise that is an error.
    ``near_names``: air-quality areas without a name get that of the only nearest lookup key, up to so many letters apart (0: equal ones only).
    """

    on_mismatch: str = "cast"
    on_missing: str = "keep"
    strict_names: bool = False
    listings_by: str | None = None
    fields_replace: bool = False
    near_names: int = 0

    @property
    def by_schema(self) -> bool:
        """Whether files must be told apart by their own schema."""
        return self.on_missing == "drop" or self.on_mismatch == "null"

    def keyed(self, frames: list[DataFrame], level: Level) -> list[DataFrame]:
        """With ``on_mismatch="null"`` a key is blanked in just the files that have another type."""
        if self.on_mismatch != "null":
            return frames
        target = level.lookup.schema[level.lookup_key].dataType
        return [align_key(frame, level.key, target, "null") if level.key in frame.columns else frame for frame in frames]


def format_air_quality(
    frames: list[DataFrame], districts: DataFrame, neighborhoods: DataFrame, choices: Choices = Choices()
) -> DataFrame:
    """Sensor rows with reconciled area names, matched on normalized names."""
    rows = conform_union(with_year(frame) for frame in frames).drop("_id", SOURCE)
    named = rows.withColumns(
        {name: normalize_name(F.col(name), strict=choices.strict_names) for name in ("Nom_districte", "Nom_barri")}
    )
    if choices.strict_names:
        neighborhoods = neighborhoods.withColumn(
            "neighborhood_name", normalize_name(F.col("neighborhood_name"), strict=True)
        )
    levels = (
        Level(districts, "Nom_districte", "district_name", "district_reconciled", "district"),
        Level(neighborhoods, "Nom_barri", "neighborhood_name", "neighborhood_reconciled", "neighborhood"),
    )
    reconciled = reconcile(named, *levels, on_mismatch=choices.on_mismatch)
    if choices.near_names:
        for level in levels:
            reconciled = add_near_name(reconciled, level, choices.near_names)
    return drop_duplicate_rows(reconciled.drop("Nom_districte", "Codi_districte", "Nom_barri", "Codi_barri"))


def format_income(
    frames: list[DataFrame], districts: DataFrame, neighborhoods: DataFrame, choices: Choices = Choices()
) -> DataFrame:
    """Income rows with reconciled area names; of the yearly figures the first one."""
    level = Level(districts, "district_name", "district", "district_reconciled", "district")
    rows = conform_union(choices.keyed(frames, level)).drop("_id", SOURCE)
    named = reconcile(
        rows,
        level,
        # The landing column is spelled with a blank at its end.
        Level(neighborhoods, "neigh_name ", "neighborhood", "neighborhood_reconciled", "neighborhood"),
        drop=("district_name", "district_id", "neigh_name "),
        on_mismatch=choices.on_mismatch,
    )
    return drop_duplicate_rows(first_element(named, "info", ("RFD", "pop", "year")))


def format_listings(
    frames: list[DataFrame], districts: DataFrame, neighborhoods: DataFrame, choices: Choices = Choices()
) -> DataFrame:
    """Listings with flat columns, the day they were listed, and reconciled area names, each once."""
    return drop_duplicate_rows(named_listings(frames, districts, neighborhoods, choices))


def named_listings(frames: list[DataFrame], districts: DataFrame, neighborhoods: DataFrame, choices: Choices = Choices()) -> DataFrame:
    """The same with the copies."""
    frames = [frame.drop(*LISTING_UNUSED) for frame in frames]
    for column in LISTING_STRUCTS:
        frames = flatten_in_frames(frames, column, choices.on_missing, choices.fields_replace)
    level = Level(districts, "district", "di", "di_re", "district")
    rows = with_day(conform_union(choices.keyed(frames, level))).drop(SOURCE)
    return reconcile(
        rows,
        level,
        Level(neighborhoods, "neighborhood", "ne", "ne_re", "neighborhood"),
        on_mismatch=choices.on_mismatch,
    )


def run(spark: SparkSession, landing: Landing, formatted: Zone, choices: Choices = Choices(), incremental: bool = False) -> None:
    """Read, reconcile, de-duplicate and replace the three formatted tables.

    ``incremental`` loads of the listings only the files that the table does not have yet (see ``load_new``); the two small tables are replaced.
    """

    def lookup(path: str) -> DataFrame:
        return read_files(spark, "json", path)

    with sized_for(spark, landing.listings, landing.income, landing.air_quality):
        districts, neighborhoods = lookup(landing.income_districts), lookup(landing.income_neighborhoods)
        income_frames = landing_frames(
            spark, landing.income, schema=landing.income_schema, by_schema=choices.by_schema
        )
        air_frames = landing_frames(spark, landing.air_quality, schema=landing.air_quality_schema)
        formatted.write("income", format_income(income_frames, districts, neighborhoods, choices), "overwrite")
        formatted.write("air_quality", format_air_quality(air_frames, districts, neighborhoods, choices), "overwrite")
        names = lookup(landing.listing_districts), lookup(landing.listing_neighborhoods)
        if incremental:
            # What the rows follow from beside the files.
            stamp = f"{fingerprint(*names)} {choices} {landing.listings_schema}"
            shape = partial(named_listings, districts=names[0], neighborhoods=names[1], choices=choices)
            loaded = load_new(
                formatted, "listings", landing.listings, shape, schema=landing.listings_schema, by_schema=choices.by_schema, stamp=stamp, distinct=True,
                partition_by=choices.listings_by,
            )
            log.info("listings: %s", loaded)
            return
        listing_frames = landing_frames(
            spark, landing.listings, "daily", landing.listings_schema, by_schema=choices.by_schema
        )
        listings = format_listings(listing_frames, *names, choices)
        formatted.write("listings", listings, "overwrite", partition_by=choices.listings_by)
