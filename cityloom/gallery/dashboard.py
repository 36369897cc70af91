"""Dashboard queries."""

from pyspark.sql import functions as F

from cityloom.gallery.registry import query, table
from cityloom.operators import marts


@query("mart_distinct", "SELECT DISTINCT event_type, user_id FROM events")
def mart_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return marts.distinct_rows(events.unionAll(events), "event_type", "user_id")


def _area_counts(spark, sf_dir):
    """Customers per area and market segment, as two runs of a job left them; one area has no name."""
    nation = table(spark, sf_dir, "nation").where("n_name <> 'NATION_3'")
    named = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    once = named.groupBy(F.col("n_name").alias("neighborhood"), "c_mktsegment").count().drop("c_mktsegment")
    return once.unionAll(once)


_AREA_COUNTS = """
    rows AS (
        SELECT DISTINCT neighborhood, count FROM (
            SELECT CASE WHEN n_name <> 'NATION_3' THEN n_name END AS neighborhood, c_mktsegment, count(*) AS count
            FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    )"""


@query(
    "mart_top_areas",
    f"""
    WITH {_AREA_COUNTS}
    SELECT neighborhood, sum(count)::BIGINT AS count FROM rows WHERE neighborhood IS NOT NULL
    GROUP BY 1 HAVING count(neighborhood) <= 4 ORDER BY 2 DESC, 1
    """,
)
def mart_top_areas(spark, sf_dir):
    return marts.top_areas(_area_counts(spark, sf_dir), rows_per_area=4)


@query(
    "mart_top_sellers",
    f"""
    WITH {_AREA_COUNTS}
    SELECT neighborhood, sum(count)::BIGINT AS count FROM rows
    WHERE neighborhood IS NULL OR neighborhood NOT IN ('NATION_1', 'NATION_7')
    GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST
    """,
)
def mart_top_sellers(spark, sf_dir):
    return marts.top_sellers(_area_counts(spark, sf_dir), ["NATION_1", "NATION_7"])


@query(
    "mart_having_count",
    "SELECT l_orderkey, count(l_orderkey) AS n FROM lineitem GROUP BY 1 HAVING count(l_orderkey) <= 5",
)
def mart_having_count(spark, sf_dir):
    return marts.groups_of_at_most(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "mart_kpis",
    """
    SELECT "KPI", max("Value") AS max_value, round(sum("Value"), 2) AS sum_value
    FROM (SELECT DISTINCT event_type AS "KPI", value AS "Value" FROM events) GROUP BY 1
    """,
)
def mart_kpis(spark, sf_dir):
    values = table(spark, sf_dir, "events").select(F.col("event_type").alias("KPI"), F.col("value").alias("Value"))
    return marts.kpi_summary(values.unionAll(values)).withColumn("sum_value", F.round("sum_value", 2))
