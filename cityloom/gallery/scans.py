"""Sources and sinks."""

from pyspark.sql import functions as F

from cityloom.gallery.registry import query, table
from cityloom.operators.conform import conform_union
from cityloom.operators.incremental import append_distinct
from cityloom.operators.shape import flatten_in_frames
from cityloom.session import scratch_dir
from cityloom.sources.landing import SOURCE, landing_frames, read_files, with_day, with_year
from cityloom.sources.ledger import load_new
from cityloom.sources.zones import Zone, preview


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(spark, sf_dir):
    return read_files(spark, "parquet", f"{sf_dir}/customer.parquet")


@query(
    "scan_csv_strings",
    """
    SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
           c_acctbal::VARCHAR AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def scan_csv_strings(spark, sf_dir):
    root = scratch_dir(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(f"{root}/customer.csv", header=True)
    return conform_union(landing_frames(spark, root)).drop(SOURCE)


@query(
    "scan_csv_declared",
    """
    SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
           c_acctbal::VARCHAR AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def scan_csv_declared(spark, sf_dir):
    root = scratch_dir(spark, "csv")
    customer = table(spark, sf_dir, "customer")
    customer.write.csv(f"{root}/customer.csv", header=True)
    schema = ", ".join(f"{name} string" for name in customer.columns)
    return conform_union(landing_frames(spark, root, schema=schema)).drop(SOURCE)


@query(
    "scan_json_inferred",
    """
    SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
)
def scan_json_inferred(spark, sf_dir):
    root = scratch_dir(spark, "json")
    table(spark, sf_dir, "customer").write.json(f"{root}/customer.json")
    return conform_union(landing_frames(spark, root)).drop(SOURCE)


@query(
    "scan_mixed_formats",
    """
    SELECT 'customer.csv' AS source_entry, c_custkey::VARCHAR AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier.json', s_suppkey::VARCHAR, s_name FROM supplier
    UNION ALL SELECT 'part.parquet', p_partkey::VARCHAR, p_name FROM part
    """,
)
def scan_mixed_formats(spark, sf_dir):
    root = scratch_dir(spark, "mixed")
    customer, supplier, part = (table(spark, sf_dir, name) for name in ("customer", "supplier", "part"))
    customer.selectExpr("c_custkey AS id", "c_name AS name").write.csv(f"{root}/customer.csv", header=True)
    supplier.selectExpr("s_suppkey AS id", "s_name AS name").write.json(f"{root}/supplier.json")
    part.selectExpr("p_partkey AS id", "p_name AS name").write.parquet(f"{root}/part.parquet")
    customer.select("c_name").write.text(f"{root}/names.txt")
    return conform_union(landing_frames(spark, root))


@query(
    "year_from_file_name",
    """
    SELECT year(o_orderdate)::VARCHAR AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def year_from_file_name(spark, sf_dir):
    root = scratch_dir(spark, "yearly")
    orders = table(spark, sf_dir, "orders")
    orders.withColumn("file", F.concat(F.year("o_orderdate").cast("string"), F.lit("_orders.csv"))).write.partitionBy(
        "file"
    ).csv(root, header=True)
    yearly = with_year(conform_union(landing_frames(spark, root)))
    total = F.round(F.sum(F.col("o_totalprice").cast("double")), 2)
    return yearly.groupBy("year").agg(F.count("*").alias("n"), total.alias("total"))


@query("daily_folder_scan", "SELECT ts::DATE AS date, event_id, user_id, event_type, value, props FROM events")
def daily_folder_scan(spark, sf_dir):
    root = scratch_dir(spark, "daily")
    events = table(spark, sf_dir, "events")
    day = F.concat(F.date_format("ts", "yyyy_MM_dd"), F.lit("_events"))
    events.withColumn("day", day).drop("ts").write.partitionBy("day").parquet(root)
    return with_day(conform_union(landing_frames(spark, root, "daily"))).drop(SOURCE)


@query("landing_drop_declared", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0")
def landing_drop_declared(spark, sf_dir):
    """Files without the struct are left out also where a schema is declared."""
    root = scratch_dir(spark, "declared")
    customer = table(spark, sf_dir, "customer")
    detail = F.struct("c_mktsegment").alias("detail")
    customer.where("c_custkey % 3 = 0").select("c_custkey", detail).write.json(f"{root}/with.json")
    customer.where("c_custkey % 3 <> 0").select("c_custkey").write.json(f"{root}/without.json")
    frames = landing_frames(spark, root, schema="c_custkey bigint, detail struct<c_mktsegment:string>", by_schema=True)
    return conform_union(flatten_in_frames(frames, "detail", "drop")).drop(SOURCE)


@query(
    "landing_empty_objects",
    """
    SELECT 'full.json' AS source_entry, c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'void.json', NULL, NULL FROM customer WHERE c_custkey % 2 <> 0
    """,
)
def landing_empty_objects(spark, sf_dir):
    """Lines without any column stay as rows of NULL."""
    root = scratch_dir(spark, "objects")
    customer = table(spark, sf_dir, "customer")
    customer.where("c_custkey % 2 = 0").select("c_custkey", "c_name").write.json(f"{root}/full.json")
    # Spark writes its own objects without fields as such lines.
    customer.where("c_custkey % 2 <> 0").select(F.lit(None).cast("string").alias("c_name")).write.json(f"{root}/void.json")
    return conform_union(landing_frames(spark, root, by_schema=True))


@query(
    "zone_roundtrip",
    """
    SELECT 'customer' AS table_name, c_custkey AS key, c_name AS name, c_acctbal AS value, NULL::TIMESTAMP AS day FROM customer
    UNION ALL SELECT 'orders', o_orderkey, o_orderpriority, o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def zone_roundtrip(spark, sf_dir):
    zone = Zone(spark, scratch_dir(spark, "zone"))
    names = {"customer": ("c_custkey", "c_name", "c_acctbal"), "orders": ("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"), "supplier": ("s_suppkey", "s_name", "s_acctbal")}
    for name in names:
        zone.write(name, table(spark, sf_dir, name))
    tables = zone.read_all(*names)
    return conform_union(
        tables[name].select(F.lit(name).alias("table_name"), *[F.col(c).alias(new) for c, new in zip(columns, ("key", "name", "value", "day"))])
        for name, columns in names.items()
    )


@query(
    "zone_append_columns",
    """
    SELECT c_custkey, NULL AS c_name, NULL::INT AS c_nationkey FROM customer
    UNION ALL SELECT c_custkey, c_name, NULL FROM customer
    UNION ALL SELECT c_custkey, NULL, c_nationkey FROM customer
    """,
)
def zone_append_columns(spark, sf_dir):
    """Runs that differ in columns, read as one table."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    for columns in (["c_custkey"], ["c_custkey", "c_name"], ["c_nationkey", "c_custkey"]):
        zone.write("customer", table(spark, sf_dir, "customer").select(*columns))
    return zone.read("customer")


@query("zone_partition_text", "SELECT o_orderkey, lpad((o_custkey % 10)::VARCHAR, 2, '0') AS code, o_orderdate::DATE AS day FROM orders WHERE o_custkey % 10 <> 3 UNION ALL SELECT o_orderkey, NULL, o_orderdate::DATE FROM orders WHERE o_custkey % 10 = 3")
def zone_partition_text(spark, sf_dir):
    """A text partition such as 01 comes back as the same text, NULL as NULL."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    code = F.when(F.col("o_custkey") % 10 != 3, F.lpad((F.col("o_custkey") % 10).cast("string"), 2, "0"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), F.col("o_orderdate").cast("date").alias("day"))
    zone.write("orders", rows, "overwrite", partition_by="code")
    return zone.read("orders")


@query(
    "zone_partitioned",
    """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
    """,
)
def zone_partitioned(spark, sf_dir):
    zone = Zone(spark, scratch_dir(spark, "zone"))
    zone.write("orders", table(spark, sf_dir, "orders"), "overwrite", partition_by="o_orderpriority")
    by_priority = zone.read("orders").groupBy("o_orderpriority")
    return by_priority.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("sink_append", "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY 1")
def sink_append(spark, sf_dir):
    zone = Zone(spark, scratch_dir(spark, "zone"))
    for _ in range(2):
        zone.write("customer", table(spark, sf_dir, "customer"))
    return zone.read("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("sink_overwrite", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def sink_overwrite(spark, sf_dir):
    zone = Zone(spark, scratch_dir(spark, "zone"))
    zone.write("rows", table(spark, sf_dir, "supplier"))
    zone.write("rows", table(spark, sf_dir, "customer"), "overwrite")
    return zone.read("rows").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("sink_drop", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def sink_drop(spark, sf_dir):
    zone = Zone(spark, scratch_dir(spark, "zone"))
    zone.write("rows", table(spark, sf_dir, "customer"))
    zone.drop("rows")
    zone.write("rows", table(spark, sf_dir, "customer"))
    return zone.read("rows").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "preview_rows",
    """
    SELECT *, 'struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>'
              AS frame_schema
    FROM customer ORDER BY c_custkey LIMIT 5
    """,
)
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "customer"), "c_custkey")


@query("csv_blank_first_line", "SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS c_mktsegment FROM customer")
def csv_blank_first_line(spark, sf_dir):
    """Files whose header follows blank lines, beside others with the same and with another header."""
    root = scratch_dir(spark, "blank")
    customer = table(spark, sf_dir, "customer")
    for rest, blank, columns in ((0, "\n \n", ["c_custkey", "c_name"]), (1, "", ["c_custkey", "c_name"]), (2, "\n", ["c_custkey", "c_name", "c_mktsegment"])):
        lines = customer.where(f"c_custkey % 3 = {rest}").select(F.lit(1).alias("at"), "c_custkey", F.concat_ws(",", *columns).alias("value"))
        header = spark.createDataFrame([(0, -1, blank + ",".join(columns))], "at int, c_custkey bigint, value string")
        # One file, so that the header is on its top.
        lines.unionByName(header).coalesce(1).sortWithinPartitions("at", "c_custkey").select("value").write.text(f"{root}/part{rest}.csv")
    return conform_union(landing_frames(spark, root)).drop(SOURCE)


@query("sink_failed_replace", "SELECT c_custkey, c_name FROM customer")
def sink_failed_replace(spark, sf_dir):
    """A replacement that fails midway leaves the old rows."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    zone.write("customer", customer)
    last = customer.agg(F.max("c_custkey")).first()[0]
    failing = customer.withColumn("c_name", F.when(F.col("c_custkey") == last, F.raise_error(F.lit("midway")).cast("string")).otherwise(F.lit("new")))
    try:
        zone.write("customer", failing, "overwrite")
    except Exception as error:
        if "midway" not in str(error):
            raise
    else:
        raise AssertionError("the write was meant to fail")
    return zone.read("customer")


@query("zone_replace_from_itself", "SELECT c_custkey, 2 * c_acctbal AS c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def zone_replace_from_itself(spark, sf_dir):
    """A table replaced by rows read from it, twice."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    zone.write("customer", table(spark, sf_dir, "customer"))
    zone.write("customer", zone.read("customer").where("c_custkey % 2 = 0"), "overwrite")
    zone.write("customer", zone.read("customer").select("c_custkey", (2 * F.col("c_acctbal")).alias("c_acctbal")), "overwrite")
    return zone.read("customer")


def _write_days(events, root, days):
    day = F.concat(F.date_format("ts", "yyyy_MM_dd"), F.lit("_events"))
    events.where(days).withColumn("day", day).drop("ts").write.mode("append").partitionBy("day").json(root)


@query("daily_incremental", "SELECT ts::DATE AS date, event_id, user_id, event_type, value, props FROM events")
def daily_incremental(spark, sf_dir):
    """Day folders loaded in three runs, of which the second and third read what is new only."""
    root, zone = scratch_dir(spark, "daily"), Zone(spark, scratch_dir(spark, "zone"))
    events = table(spark, sf_dir, "events")
    middle = F.lit(events.agg(F.percentile_approx(F.unix_date(F.col("ts").cast("date")), 0.5)).first()[0])
    day = F.unix_date(F.col("ts").cast("date"))
    done = []
    for part in (day < middle, (day >= middle) & (F.col("event_id") % 2 == 0), (day >= middle) & (F.col("event_id") % 2 != 0)):
        _write_days(events, f"{root}/in", part)
        done.append(load_new(zone, "events", f"{root}/in", lambda frames: with_day(conform_union(frames)).drop(SOURCE)))
    if done != ["replaced", "added", "added"] or load_new(zone, "events", f"{root}/in", conform_union) != "nothing":
        raise AssertionError(f"loads: {done}")
    return zone.read("events")


@query("dedupe_incremental", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedupe_incremental(spark, sf_dir):
    """Rows in four loads that repeat each other, each kept once; the loads differ in columns where a column is NULL."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    for part in ("l_linenumber <= 2", "l_linenumber >= 2 AND l_linenumber <= 4", "l_linenumber <= 1", "l_linenumber >= 3"):
        append_distinct(zone, "lines", lines.where(part), buckets=8)
    return zone.read("lines")


@query(
    "zone_views",
    "SELECT o_orderpriority, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderpriority, c_mktsegment",
)
def zone_views(spark, sf_dir):
    """Tables of a zone, queried by their names in SQL text."""
    zone = Zone(spark, scratch_dir(spark, "zone"))
    for name in ("orders", "customer"):
        zone.write(name, table(spark, sf_dir, name))
    zone.as_views("orders", "customer", prefix="shown_")
    return spark.sql("SELECT o_orderpriority, c_mktsegment, count(*) AS n FROM shown_orders JOIN shown_customer ON o_custkey = c_custkey GROUP BY o_orderpriority, c_mktsegment")
