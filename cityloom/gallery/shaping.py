"""Columns, unions, keys, names."""

from pyspark.sql import functions as F

from cityloom.functions.text import normalize_name
from cityloom.gallery.registry import query, table
from cityloom.operators import shape
from cityloom.operators.conform import conform_union, drop_duplicate_rows
from cityloom.operators.lookup import Level, add_name, reconcile
from cityloom.operators.near import near_names
from cityloom.operators.relate import left_join_suffixed


@query("drop_rename", "SELECT c_custkey AS customer, c_acctbal AS balance, c_mktsegment FROM customer")
def drop_rename(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").drop("c_name", "c_nationkey", "not_there")
    return customer.withColumnsRenamed({"c_custkey": "customer", "c_acctbal": "balance"})


@query("select_features", "SELECT p_partkey, p_brand, p_size FROM part")
def select_features(spark, sf_dir):
    part = table(spark, sf_dir, "part").drop("p_retailprice")
    return shape.select_present(part, ["p_partkey", "p_weight", "p_brand", "p_size"])


@query(
    "flatten_struct",
    """
    SELECT event_id, event_type, (props::JSON ->> 'k')::BIGINT AS k FROM events
    """,
)
def flatten_struct(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint").alias("props")
    )
    return shape.flatten_struct(events, "props")


@query(
    "first_array_element",
    """
    SELECT doc_id, lines[1] AS line, length(lines[1]) AS n_chars
    FROM (SELECT doc_id, CASE WHEN text <> '' THEN string_split(text, chr(10)) ELSE [] END AS lines FROM documents)
    """,
)
def first_array_element(spark, sf_dir):
    lines = F.when(F.col("text") != "", F.split("text", "\n")).otherwise(F.array().cast("array<string>"))
    info = F.transform(lines, lambda line: F.struct(line.alias("line"), F.char_length(line).cast("bigint").alias("n_chars")))
    documents = table(spark, sf_dir, "documents").select("doc_id", info.alias("info"))
    return shape.first_element(documents, "info", ("line", "n_chars"))


@query(
    "conform_union",
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS name, c_acctbal AS amount, c_mktsegment AS segment, NULL::INT AS size
    FROM customer
    UNION ALL SELECT s_suppkey::VARCHAR, s_name, s_acctbal, NULL, NULL FROM supplier
    UNION ALL SELECT p_partkey::VARCHAR, p_name, NULL, NULL, p_size FROM part
    """,
)
def union_of_frames(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS amount", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "string(s_suppkey) AS id", "s_name AS name", "s_acctbal AS amount"
    )
    part = table(spark, sf_dir, "part").selectExpr("p_size AS size", "p_name AS name", "p_partkey AS id", "NULL AS segment")
    return conform_union([customer, supplier, part])


def _orders_with_text_key(spark, sf_dir):
    """Orders whose customer key is text; for status P it is no number."""
    key = F.concat(F.when(F.col("o_orderstatus") == "P", "x").otherwise(""), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("customer"))


def _customer_name(spark, sf_dir):
    return Level(table(spark, sf_dir, "customer"), "customer", "c_custkey", "c_name", "name")


@query(
    "align_key_cast",
    """
    SELECT o_orderkey, c_custkey AS customer, c_name AS name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderstatus <> 'P'
    """,
)
def align_key_cast(spark, sf_dir):
    return add_name(_orders_with_text_key(spark, sf_dir), _customer_name(spark, sf_dir))


@query("align_key_null", "SELECT o_orderkey, NULL::BIGINT AS customer, NULL::VARCHAR AS name FROM orders")
def align_key_null(spark, sf_dir):
    return add_name(_orders_with_text_key(spark, sf_dir), _customer_name(spark, sf_dir), on_mismatch="null")


@query(
    "join_suffix_collisions",
    """
    SELECT o_custkey AS key, o_orderpriority AS name, o_totalprice AS total,
           c_custkey AS key_1, c_name AS name_1, c_acctbal AS balance
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def join_suffix_collisions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_custkey AS key", "o_orderpriority AS name", "o_totalprice AS total")
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance")
    return left_join_suffixed(orders, customer, "key", "key")


def labelled(spark, sf_dir):
    """Documents with their labels; NULL where a document has none."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "null_profile",
    """
    UNPIVOT (
        SELECT count_if(d.doc_id IS NULL)::BIGINT AS doc_id, count_if(text IS NULL)::BIGINT AS text,
               count_if(lang IS NULL)::BIGINT AS lang, count_if(source IS NULL)::BIGINT AS source,
               count_if(n_chars IS NULL)::BIGINT AS n_chars, count_if(quality IS NULL)::BIGINT AS quality,
               count_if(toxic IS NULL)::BIGINT AS toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ) ON COLUMNS(*) INTO NAME column_name VALUE nulls
    """,
)
def null_profile(spark, sf_dir):
    return shape.null_profile(labelled(spark, sf_dir))


@query("drop_null_columns", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def drop_null_columns(spark, sf_dir):
    return shape.drop_null_columns(labelled(spark, sf_dir), protect=["n_chars"])


@query("frame_shape", "SELECT count(*) AS n_rows, 11::INTEGER AS n_columns FROM lineitem")
def frame_shape(spark, sf_dir):
    return shape.frame_shape(table(spark, sf_dir, "lineitem"))


@query(
    "normalize_text",
    r"""
    SELECT doc_id, regexp_replace(strip_accents(replace(lower(text), '-', ' ')), '[^\x00-\x7F]', '', 'g') AS name
    FROM documents
    """,
)
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", normalize_name(F.col("text")).alias("name"))


@query(
    "reconcile_one_level",
    """
    SELECT d.doc_id, lang, source, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def reconcile_one_level(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels")
    return reconcile(documents, Level(labels, "doc_id", "doc_id", "quality", "quality"))


@query(
    "reconcile_two_level",
    """
    SELECT c_custkey, c_name, r_name AS district, CASE WHEN r_name <> 'ASIA' THEN n_name END AS neighborhood
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def reconcile_two_level(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = table(spark, sf_dir, "nation").join(region, "n_regionkey")
    return reconcile(
        customer,
        Level(nation, "c_nationkey", "n_nationkey", "r_name", "district"),
        Level(nation.where("r_name <> 'ASIA'"), "c_nationkey", "n_nationkey", "n_name", "neighborhood"),
        drop=("c_nationkey",),
    )


@query(
    "reconcile_normalized",
    """
    SELECT p_partkey, CASE WHEN p_name NOT LIKE 'hot%' THEN upper(p_name) END AS label FROM part
    """,
)
def reconcile_normalized(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    spelled = part.select("p_partkey", F.translate(F.initcap("p_name"), " eoa", "-éöà").alias("spelled"))
    known = part.where("p_name NOT LIKE 'hot%'").select("p_name", F.upper("p_name").alias("label")).distinct()
    named = spelled.withColumn("spelled", normalize_name(F.col("spelled")))
    return reconcile(named, Level(known, "spelled", "p_name", "label", "label"), drop=("spelled",))


@query("dedupe_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_rows(spark, sf_dir):
    return drop_duplicate_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "emptiness_test",
    """
    SELECT 'orders' AS name, count(*) = 0 AS is_empty FROM orders
    UNION ALL SELECT 'negative keys', count(*) = 0 FROM orders WHERE o_orderkey < 0
    UNION ALL SELECT 'without status', count(*) = 0 FROM orders WHERE o_orderstatus IS NULL
    """,
)
def emptiness_test(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    frames = {"orders": orders, "negative keys": orders.where("o_orderkey < 0"), "without status": orders.where("o_orderstatus IS NULL")}
    return conform_union(shape.emptiness(frame).select(F.lit(name).alias("name"), "is_empty") for name, frame in frames.items())


_NEAR_KEYS = """
    spelled AS (
        SELECT 'part' AS kind, p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2) WHEN 2 THEN replace(p_name, 'e', 'ie')
            WHEN 3 THEN p_name || 'xyz' ELSE replace(p_name, ' ', '') END AS name FROM part
        UNION ALL
        SELECT 'supplier', s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN replace(s_name, '#', '') WHEN 1 THEN substr(s_name, 10) ELSE substr(s_name, 17) END FROM supplier
    ), known AS (
        SELECT DISTINCT p_name AS name FROM part WHERE p_name NOT LIKE 'hot%'
        UNION SELECT s_name FROM supplier
        UNION SELECT substr(s_name, 16) FROM supplier
    )"""


@query(
    "reconcile_near",
    f"""
    WITH {_NEAR_KEYS}, pairs AS (
        SELECT s.name, k.name AS match, levenshtein(s.name, k.name) AS distance
        FROM (SELECT DISTINCT name FROM spelled) s, known k WHERE levenshtein(s.name, k.name) <= 2
    ), best AS (
        SELECT name, distance, count(*) AS n_nearest, min(match) AS match FROM pairs WHERE (name, distance) IN (SELECT (name, min(distance)) FROM pairs GROUP BY name) GROUP BY name, distance
    )
    SELECT kind, id, name, distance::INT AS distance, n_nearest, CASE WHEN n_nearest = 1 THEN upper(match) END AS label FROM spelled LEFT JOIN best USING (name)
    """,
)
def reconcile_near(spark, sf_dir):
    """Names that were spelled otherwise, each with the nearest known name, or with how many are equally near."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    changed = F.expr(
        "CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2) WHEN 2 THEN replace(p_name, 'e', 'ie') WHEN 3 THEN p_name || 'xyz' ELSE replace(p_name, ' ', '') END"
    )
    short = F.expr("CASE s_suppkey % 3 WHEN 0 THEN replace(s_name, '#', '') WHEN 1 THEN substr(s_name, 10) ELSE substr(s_name, 17) END")
    spelled = part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), changed.alias("name"))
    spelled = spelled.unionByName(supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), short.alias("name")))
    known = part.where("p_name NOT LIKE 'hot%'").select(F.col("p_name").alias("name")).union(supplier.select("s_name")).union(supplier.selectExpr("substr(s_name, 16)")).distinct()
    nearest = near_names(spelled, known, 2).select("name", "distance", "n_nearest", F.upper("match").alias("label"))
    return spelled.join(nearest, "name", "left")


@query(
    "column_profile",
    """
    UNPIVOT (
        SELECT count_if(o_orderkey IS NULL)::BIGINT AS o_orderkey, count_if(o_custkey IS NULL)::BIGINT AS o_custkey, count_if(o_orderstatus IS NULL)::BIGINT AS o_orderstatus,
            count_if(o_totalprice IS NULL)::BIGINT AS o_totalprice, count_if(o_orderdate IS NULL)::BIGINT AS o_orderdate, count_if(o_orderpriority IS NULL)::BIGINT AS o_orderpriority,
            count_if(o_custkey % 7 <> 0)::BIGINT AS seventh, (SELECT count(*) FROM orders)::BIGINT AS void FROM orders
    ) ON COLUMNS(*) INTO NAME column_name VALUE nulls
    """,
)
def column_profile(spark, sf_dir):
    """NULLs of every column from two halves of a table; an estimate outside its error is an error."""
    orders = table(spark, sf_dir, "orders").withColumns({"seventh": F.when(F.col("o_custkey") % 7 == 0, F.col("o_totalprice")), "void": F.lit(None).cast("int")})
    halves = [shape.profile_state(orders.where(F.col("o_orderkey") % 2 == rest)) for rest in (0, 1)]
    common = ["column_name", "n_rows", "nulls", "distinct", "quantiles"]
    found = shape.column_profile(shape.merged_profiles(halves[0].select(*common).unionByName(halves[1].select(*common))))
    names = {f"c{i}": name for i, name in enumerate(orders.columns)}
    exact = orders.toDF(*names).agg(*[F.count_distinct(name).alias(name) for name in names])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(column).alias("column_name"), F.col(name).alias("different")) for name, column in names.items()])))
    # Three standard errors of the distinct counts; the share of prices below the estimated median.
    off = F.abs(F.col("distinct") - F.col("different")) > 3 * 1.04 / 2 ** (shape.DISTINCT_BITS / 2) * F.col("different") + 1
    median = found.where("column_name = 'o_totalprice'").select("median").scalar()
    share = orders.select(F.avg((F.col("o_totalprice") < median).cast("double"))).scalar()
    wrong = off | ((F.col("column_name") == "o_totalprice") & (F.abs(share - 0.5) > 0.03))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("estimate off: "), "column_name")).cast("bigint")).otherwise(F.col("nulls"))
    return found.join(exact, "column_name").select("column_name", checked.alias("nulls"))
