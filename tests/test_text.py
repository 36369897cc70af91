import sys
import unicodedata

from pyspark.sql import functions as F

from cityloom.functions.columns import epoch_seconds, in_train_share
from cityloom.functions.text import normalize_name


def by_rule(text):
    return unicodedata.normalize("NFKD", text.lower().replace("-", " ")).encode("ascii", "ignore").decode()


def test_every_character(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["|".join(chr(c) + chr(c) for c in codes[i : i + 500]) for i in range(0, len(codes), 500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_name(F.col("t")).alias("n"))
    wrong = [(t, n) for t, n in got.collect() if n != by_rule(t)]
    assert not wrong


def test_names(spark):
    cases = {
        "Horta-Guinardó": "horta guinardo",
        "l'Antiga Esquerra": "l'antiga esquerra",
        "ﬁ… №": "fi... no",
        "": "",
        None: None,
        "-": " ",
        "日本": "",
    }
    cases["ﬁ… №"] = by_rule("ﬁ… №")
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", normalize_name(F.col("t")).alias("n"))
    assert {t: n for t, n in df.collect()} == cases


def test_strict_names(spark):
    df = spark.createDataFrame([('"Sant Pere, Santa Caterina"',), ("la Vall d'Hebron",)], "t string")
    got = [r[0] for r in df.select(normalize_name(F.col("t"), strict=True)).collect()]
    assert got == ["sant pere, santa caterina", "la vall d hebron"]


def test_epoch_ignores_session_zone(spark):
    df = spark.sql("SELECT date'2024-03-31' AS d, timestamp_ntz'2024-03-31 23:59:59' AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(epoch_seconds(F.col("d")), epoch_seconds(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (1711843200, 1711843200)


def test_split_is_the_same_for_any_partitioning(spark):
    keys = spark.range(5000)
    train = in_train_share(F.col("id"))
    one = {r[0] for r in keys.coalesce(1).where(train).collect()}
    many = {r[0] for r in keys.repartition(13).where(train).collect()}
    assert one == many
    assert abs(len(one) / 5000 - 0.8) < 0.03
    other = {r[0] for r in keys.where(in_train_share(F.col("id"), seed=7)).collect()}
    assert other != one


def test_split_shares(spark):
    counts = spark.range(2000).agg(
        *[F.count_if(in_train_share(F.col("id"), s)).alias(str(s)) for s in (0.0, 0.25, 0.5, 1.0)]
    ).first()
    assert counts["0.0"] == 0 and counts["1.0"] == 2000
    assert abs(counts["0.25"] - 500) < 100 and abs(counts["0.5"] - 1000) < 100
