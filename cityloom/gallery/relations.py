"""Inner joins between data sets."""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from cityloom.gallery.registry import QUERIES, SQL, query, table
from cityloom.operators.relate import join_keeping_left
from cityloom.plans.training import model_rows


@query(
    "inner_join_multikey",
    """
    SELECT year(l_shipdate)::VARCHAR AS year, o_orderpriority, count(*) AS n,
           round(sum(l_extendedprice), 2) AS price, round(sum(o_totalprice), 2) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND year(l_shipdate) = year(o_orderdate)
    GROUP BY 1, 2
    """,
)
def inner_join_multikey(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.year("l_shipdate").cast("string").alias("year"), "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.year("o_orderdate").alias("year"), "o_orderpriority", "o_totalprice"
    )
    joined = join_keeping_left(lines, orders, ["key", "year"])
    return joined.groupBy("year", "o_orderpriority").agg(
        F.count("*").alias("n"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


def _orders_and_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), "o_totalprice"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linestatus").alias("status"), "l_linenumber", "l_quantity"
    )
    return orders, lines


_KEEP_LEFT_SQL = """
    SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """


@query("join_keep_left", _KEEP_LEFT_SQL)
def join_keep_left(spark, sf_dir):
    return join_keeping_left(*_orders_and_lines(spark, sf_dir), ["key"])


@query("join_keep_left_hot_keys", _KEEP_LEFT_SQL)
def join_keep_left_hot_keys(spark, sf_dir):
    """The same join with the hot keys of the large side spread: what several times the rows of a usual key hold is hot here."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    per_key = lines.groupBy("key").agg(F.count("*").alias("n"))
    usual = per_key.agg(F.percentile_approx("n", 0.999)).first()[0]
    return join_keeping_left(orders, lines, ["key"], large="right", hot_rows=max(usual, 1), max_rows=0)


def _suppliers(spark, sf_dir, fine):
    """Suppliers with the name of their nation and, if ``fine``, an area of their own that orders meet."""
    supplier = table(spark, sf_dir, "supplier")
    if fine:
        in_nation = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
        supplier = supplier.withColumn("area", F.row_number().over(in_nation) - 1)
    return supplier.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))


def _customers(spark, sf_dir, fine):
    """Customers with the name of their nation and their area: the supplier of the nation that their key falls on.

    In the first nation that has suppliers all customers have one area, which is hot. A nation without suppliers has one area.
    """
    customer = table(spark, sf_dir, "customer")
    if fine:
        supplier = table(spark, sf_dir, "supplier")
        sizes = supplier.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
        first = supplier.agg(F.min("s_nationkey").alias("first"))
        area = F.when(F.col("c_nationkey") == F.col("first"), 0).otherwise(F.coalesce(F.col("c_custkey") % F.col("suppliers"), F.lit(0)))
        places = F.broadcast(sizes.crossJoin(F.broadcast(first)))
        customer = customer.join(places, F.col("c_nationkey") == F.col("s_nationkey"), "left").select(customer["*"], area.alias("area"))
    return customer.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def _area(fine):
    return F.concat_ws("-", "n_name", F.col("area").cast("string")) if fine else F.col("n_name")


def sensor_rows(spark, sf_dir, fine=False):
    """Lines shipped, as sensor rows: area of the supplier, year as text, a code as text that is no number for returns."""
    supplier = _suppliers(spark, sf_dir, fine)
    lines = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    code = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_linenumber").cast("string"))
    return lines.select(
        _area(fine).alias("neighborhood"),
        F.year("l_shipdate").cast("string").alias("year"),
        code.alias("Codi_Contaminant"),
    )


def listing_rows(spark, sf_dir, fine=False):
    """Orders, as listings: area of the customer, date, price."""
    customer = _customers(spark, sf_dir, fine)
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        _area(fine).alias("neighborhood"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("price")
    )


def income_rows(spark, sf_dir, fine=False):
    """Suppliers, as income rows: area and balance."""
    supplier = _suppliers(spark, sf_dir, fine)
    return supplier.select(_area(fine).alias("neighborhood"), F.col("s_acctbal").alias("RFD"))


MET_SQL = """
    ranked AS (
        SELECT *, n_name || '-' || (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) AS neighborhood
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    ), sensor AS (
        SELECT neighborhood, year(l_shipdate) AS year, CASE WHEN l_returnflag <> 'R' THEN l_linenumber::VARCHAR ELSE 'n/a' END AS code
        FROM lineitem JOIN ranked ON l_suppkey = s_suppkey
    ), listing AS (
        SELECT n_name || '-' || CASE WHEN c_nationkey = (SELECT min(s_nationkey) FROM supplier) THEN 0
                   ELSE coalesce(c_custkey % (SELECT nullif(count(*), 0) FROM supplier WHERE s_nationkey = c_nationkey), 0) END AS neighborhood,
               year(o_orderdate) AS year, o_totalprice::DECIMAL(18, 2) AS price, o_orderdate::DATE AS date, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    ), income AS (SELECT neighborhood, s_acctbal::DECIMAL(18, 2) AS rfd FROM ranked)"""


def exact_sum(column):
    """Sum of a column of two decimals, the same in any order of the rows.

    Usual values are added as whole hundredths, which costs a fraction of a conversion to decimals; others, as of more places, as decimals.
    """
    value = F.col(column)
    number = value.cast("double")
    hundredths = F.rint(number * 100)
    usual = (F.abs(hundredths) < 1e9) & (hundredths / 100 == number)
    whole = F.sum(F.when(usual, hundredths.cast("bigint"))).cast("decimal(20,0)")
    others = F.sum(F.when(F.coalesce(usual, F.lit(False)), F.lit(None)).otherwise(value).cast("decimal(18,2)"))
    both = F.coalesce(whole, F.lit(0).cast("decimal(20,0)")) * F.lit(Decimal("0.01")) + F.coalesce(others, F.lit(0).cast("decimal(18,2)"))
    return F.when(F.count(value) > 0, both).cast("double")


@query(
    "inner_join_chain",
    f"""
    WITH {MET_SQL}
    SELECT s.neighborhood, s.year::VARCHAR AS year, s.code AS "Codi_Contaminant", count(*) AS n, sum(price)::DOUBLE AS price, sum(rfd)::DOUBLE AS rfd
    FROM sensor s JOIN listing l ON s.neighborhood = l.neighborhood AND s.year = l.year
                  JOIN income i ON s.neighborhood = i.neighborhood
    GROUP BY 1, 2, 3
    """,
)
def inner_join_chain(spark, sf_dir):
    """The chain over areas that all orders meet whose nation has a supplier, one for each supplier, one of them hot."""
    rows = model_rows(*(make(spark, sf_dir, fine=True) for make in (listing_rows, income_rows, sensor_rows)))
    return rows.groupBy("neighborhood", "year", "Codi_Contaminant").agg(
        F.count("*").alias("n"), exact_sum("price").alias("price"), exact_sum("RFD").alias("rfd")
    )


# The earlier name of the chain over areas that all orders meet.
QUERIES["inner_join_chain_all_orders"], SQL["inner_join_chain_all_orders"] = QUERIES["inner_join_chain"], SQL["inner_join_chain"]
