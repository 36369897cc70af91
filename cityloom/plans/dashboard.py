"""Dashboard job: the indicator tables, as the dashboard shows them."""

from __future__ import annotations

from collections.abc import Iterable

from cityloom.operators import marts
from cityloom.plans.indicators import KPI_TABLE, TOP_AIR_TABLE, TOP_SELLERS_TABLE
from cityloom.sources.zones import Zone

PREFIX = "dashboard_"


def run(exploitation: Zone, excluded_sellers: Iterable[str] = (), rows_per_area: int | None = 5) -> None:
    """Replace the dashboard's three tables from what the indicators job has written, runs that repeat each other once."""
    exploitation.write(PREFIX + KPI_TABLE, marts.kpi_summary(exploitation.read(KPI_TABLE)), "overwrite")
    sellers = marts.top_sellers(exploitation.read(TOP_SELLERS_TABLE), list(excluded_sellers))
    exploitation.write(PREFIX + TOP_SELLERS_TABLE, sellers, "overwrite")
    areas = marts.top_areas(exploitation.read(TOP_AIR_TABLE), rows_per_area=rows_per_area)
    exploitation.write(PREFIX + TOP_AIR_TABLE, areas, "overwrite")
