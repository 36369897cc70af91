"""Tables as the dashboard shows them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns without repeated rows, so that repeated runs of a job show once."""
    return df.select(*columns).distinct()


def groups_of_at_most(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """Rows per non-NULL key value, for the keys with at most ``rows`` of them."""
    return df.groupBy(key).agg(F.count(key).alias("n")).where(F.col("n") <= rows)


def _bars(df: DataFrame, key: str) -> DataFrame:
    total = df.groupBy(key).agg(F.sum("count").alias("count"))
    return total.orderBy(F.desc("count"), F.asc_nulls_last(key))


def top_areas(df: DataFrame, key: str = "neighborhood", rows_per_area: int | None = 5) -> DataFrame:
    """Summed counts per named area, largest first.

    Areas with more than ``rows_per_area`` distinct rows are left out (None: no such filter).
    """
    rows = distinct_rows(df, key, "count").dropna(subset=[key])
    if rows_per_area is not None:
        total = rows.groupBy(key).agg(F.sum("count").alias("count"), F.count(key).alias("n"))
        rows = total.where(F.col("n") <= rows_per_area).drop("n")
        return rows.orderBy(F.desc("count"), F.asc_nulls_last(key))
    return _bars(rows, key)


def top_sellers(df: DataFrame, excluded: Iterable[str], key: str = "neighborhood") -> DataFrame:
    """Summed counts per area except the excluded ones, largest first; rows without an area stay."""
    column = F.col(key)
    return _bars(distinct_rows(df, key, "count").where(column.isNull() | ~column.isin(*excluded)), key)


def kpi_summary(df: DataFrame) -> DataFrame:
    """Greatest and summed value per KPI over the distinct rows."""
    rows = distinct_rows(df, "KPI", "Value")
    return rows.groupBy("KPI").agg(F.max("Value").alias("max_value"), F.sum("Value").alias("sum_value"))
