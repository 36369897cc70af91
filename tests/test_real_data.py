"""Known results over the published station files, where a copy of the data is at hand.

Set CITY_STATIONS to the folder of the yearly station CSV files, and CITY_DISTRICTS and CITY_NEIGHBORHOODS
to the JSON-lines lookups of their names.
"""

import os

import pytest

from cityloom.operators.indicators import top_groups
from cityloom.operators.marts import top_areas
from cityloom.plans.formatting import Choices, format_air_quality
from cityloom.sources.landing import landing_frames, read_files

NAMES = ("CITY_STATIONS", "CITY_DISTRICTS", "CITY_NEIGHBORHOODS")
pytestmark = pytest.mark.skipif(not all(os.environ.get(n) for n in NAMES), reason="station files not at hand")

# Rows per area over the four published years.
KNOWN = [(None, 93), ("Pedralbes", 38), ("Vila de Gràcia", 28), ("El Poblenou", 16), ("Sants", 12)]


def stations(spark, **choices):
    folder, districts, neighborhoods = (os.environ[n] for n in NAMES)
    lookups = (read_files(spark, "json", path) for path in (districts, neighborhoods))
    return format_air_quality(landing_frames(spark, folder), *lookups, Choices(**choices))


def test_top_five(spark):
    air = stations(spark)
    assert air.count() == 187
    top = top_groups(air, "neighborhood")
    assert [tuple(r) for r in top.collect()] == KNOWN
    assert [tuple(r) for r in top_areas(top).collect()] == KNOWN[1:]
    assert dict(air.dtypes)["Codi_Contaminant"] == "string" and air.where("district IS NULL").isEmpty()


def test_strict_names_match_more(spark):
    unmatched = stations(spark, strict_names=True).where("neighborhood IS NULL").count()
    assert unmatched < 93
