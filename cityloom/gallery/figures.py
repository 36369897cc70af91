"""Counts, top lists, correlations, KPI table."""

from pyspark.sql import functions as F

from cityloom.gallery.registry import query, table
from cityloom.gallery.relations import income_rows, listing_rows, sensor_rows
from cityloom.gallery.shaping import labelled
from cityloom.operators import indicators as ind
from cityloom.operators.conform import conform_union
from cityloom.plans import indicators as plan
from cityloom.session import stage

_LISTING = """
    listing AS (
        SELECT n_name AS neighborhood, o_orderdate::DATE AS date, o_totalprice AS price
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    )"""
_INCOME = """
    income AS (
        SELECT n_name AS neighborhood, s_acctbal AS rfd FROM supplier JOIN nation ON s_nationkey = n_nationkey
    )"""
_SENSOR = """
    sensor AS (
        SELECT n_name AS neighborhood, year(l_shipdate) AS year,
               CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS code
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    )"""


@query("listings_per_day", "SELECT o_orderdate::DATE AS date, count(*) AS count FROM orders GROUP BY 1")
def listings_per_day(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return ind.rows_per_day(dated)


@query(
    "avg_listings_per_day",
    "SELECT round(avg(n), 6) AS value FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderdate::DATE)",
)
def avg_listings_per_day(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return ind.mean_rows_per_day(dated).select(F.round("value", 6).alias("value"))


@query(
    "latest_month_topk",
    """
    SELECT l_suppkey, count(*) AS count FROM lineitem
    WHERE date_trunc('month', l_shipdate) = (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
    """,
)
def latest_month_topk(spark, sf_dir):
    return ind.top_groups(ind.in_latest_month(table(spark, sf_dir, "lineitem"), "l_shipdate"), "l_suppkey")


@query(
    "latest_month_topk_from_cube",
    f"""
    WITH {_LISTING}
    SELECT neighborhood, count(*) AS count FROM listing
    WHERE date_trunc('month', date) = (SELECT date_trunc('month', max(date)) FROM listing)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
    """,
)
def latest_month_topk_from_cube(spark, sf_dir):
    return plan.latest_top_sellers(plan.listing_cube(listing_rows(spark, sf_dir)))


@query(
    "topk_with_null_group",
    """
    SELECT quality, count(*) AS count FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5
    """,
)
def topk_with_null_group(spark, sf_dir):
    return ind.top_groups(labelled(spark, sf_dir), "quality")


@query(
    "topk_sketch",
    """
    SELECT 'quality' AS list, quality::BIGINT AS key, n FROM (
        SELECT quality, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5)
    UNION ALL SELECT 'user', user_id, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
    UNION ALL SELECT 'order', l_orderkey, n FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)
    UNION ALL SELECT 'supplier', l_suppkey, n FROM (
        SELECT CASE WHEN l_linenumber = 1 THEN 0 ELSE l_suppkey END AS l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
    """,
)
def topk_sketch(spark, sf_dir):
    """Top lists by summaries: few keys with NULL, many keys of nearly equal counts, and one key that stands out."""
    lines = table(spark, sf_dir, "lineitem")
    hot = F.when(F.col("l_linenumber") == 1, 0).otherwise(F.col("l_suppkey")).cast("bigint").alias("key")
    lists = {
        "quality": ind.top_groups_sketched(labelled(spark, sf_dir).select(F.col("quality").cast("bigint").alias("key")), "key"),
        "user": ind.top_groups_sketched(table(spark, sf_dir, "events").select(F.col("user_id").alias("key")), "key", tracked=100),
        "order": ind.top_groups_sketched(lines.select(F.col("l_orderkey").alias("key")), "key", n=20, tracked=100, buckets=1 << 12),
        "supplier": ind.top_groups_sketched(lines.select(hot), "key", n=1, tracked=10),
    }
    return conform_union(found.select(F.lit(name).alias("list"), "key", F.col("count").alias("n")) for name, found in lists.items())


def _rounded(df):
    return df.select(F.round("value", 6).alias("value"))


@query(
    "corr_pair",
    """
    SELECT round(corr(n_chars, quality), 6) AS value FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def corr_pair(spark, sf_dir):
    return _rounded(ind.correlation(labelled(spark, sf_dir), "n_chars", "quality"))


@query(
    "corr_zero_filled",
    """
    SELECT round(corr(coalesce(n_chars, 0), coalesce(quality, 0)), 6) AS value
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def corr_zero_filled(spark, sf_dir):
    return _rounded(ind.correlation(labelled(spark, sf_dir), "n_chars", "quality", nulls="zero"))


@query(
    "corr_on_cast",
    """
    SELECT round(corr(l_extendedprice, CASE WHEN l_returnflag <> 'R' THEN l_quantity END), 6) AS value FROM lineitem
    """,
)
def corr_on_cast(spark, sf_dir):
    code = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_quantity").cast("string"))
    coded = table(spark, sf_dir, "lineitem").select("l_extendedprice", code.try_cast("double").alias("code"))
    return _rounded(ind.correlation(coded, "l_extendedprice", "code"))


@query(
    "corr_preaggregated",
    f"""
    WITH {_LISTING}, {_INCOME}
    SELECT round(corr(price, rfd), 6) AS value FROM listing JOIN income USING (neighborhood)
    """,
)
def corr_preaggregated(spark, sf_dir):
    listings, income = listing_rows(spark, sf_dir), income_rows(spark, sf_dir)
    return _rounded(ind.joined_correlation(listings, "price", income, "RFD", ["neighborhood"]))


@query(
    "kpi_table",
    f"""
    WITH {_LISTING}, {_INCOME}, {_SENSOR}
    SELECT 'average_listings_per_day' AS "KPI", round(avg(n), 6) AS "Value"
    FROM (SELECT count(*) AS n FROM listing GROUP BY date)
    UNION ALL
    SELECT 'correlation_price_RFD', round(corr(price, rfd), 6) FROM listing JOIN income USING (neighborhood)
    UNION ALL
    SELECT 'correlation_price_contaminants', round(corr(price, code), 6)
    FROM listing JOIN sensor ON listing.neighborhood = sensor.neighborhood AND year(date) = sensor.year
    """,
)
def kpi_table(spark, sf_dir):
    cube = stage(plan.listing_cube(listing_rows(spark, sf_dir)), "listing-cube")
    kpis = plan.kpis(cube, income_rows(spark, sf_dir), sensor_rows(spark, sf_dir))
    return kpis.withColumn("Value", F.round("Value", 6))
