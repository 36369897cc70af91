import zlib

import numpy as np
import pytest
from conftest import TESTDATA
from messy import CASES, empty, messy

from cityloom.llm import grams, language, queries, toxicity
from cityloom.llm.common import hash_sample
from pyspark.sql import functions as F

SF = str(TESTDATA / "sf0.01")
needs_tables = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")


def test_long_texts_have_the_same_grams_as_one_array():
    text = "".join(chr(97 + i * i % 26) for i in range(3 * grams.CHUNK // 2))
    points = grams.code_points(text)
    whole = np.unique(grams.buckets(points, (3, 4), 20))
    parts = [grams.buckets(part, (3, 4), 20) for part in grams.chunks(text, 4)]
    assert len(parts) > 1 and np.array_equal(whole, np.unique(np.concatenate(parts)))


def test_ratios_follow_the_counts(spark):
    texts = spark.createDataFrame([("aaa xyz", 1)] * 6 + [("aaa uvw", 0)] * 18, "text string, label int")
    counts = toxicity.count_features(texts)
    buckets, ratios, rows = toxicity.log_ratios(counts)
    assert rows == (18, 6)
    only_toxic = grams.buckets(grams.code_points("xyz"), (3,), toxicity.BITS)[0]
    expected = np.log((6 + toxicity.SMOOTHING * 0.25) / 6 / ((0 + toxicity.SMOOTHING * 0.75) / 18))
    assert ratios[buckets == only_toxic] == pytest.approx(expected)
    assert grams.buckets(grams.code_points("aaa"), (3,), toxicity.BITS)[0] not in buckets


def test_toxicity_of_messy_rows(spark):
    training = spark.createDataFrame([("you vile scoundrel", 1), ("a calm day", 0), (None, 0), ("x", None), ("y", 7)] * 8, "text string, label int")
    model = toxicity.train(training)
    rows = messy(spark).select("text", toxicity.toxic_score(model, "text").alias("found")).collect()
    assert len(rows) == len(CASES) and all(0 <= r.found < 0.5 for r in rows)
    assert toxicity.score("what a VILE scoundrel", model.table(), model.bias) > 0.5


def test_toxicity_without_both_labels(spark):
    for label, side in ((0, 0), (1, 1)):
        model = toxicity.train(spark.createDataFrame([("text", label)] * 5, "text string, label int"))
        assert round(toxicity.score("anything", model.table(), model.bias)) == side
    assert toxicity.score("text", toxicity.train(spark.createDataFrame([], "text string, label int")).table(), -30.0) < 0.5
    assert toxicity.without_toxic(empty(spark), spark.createDataFrame([], "doc_id bigint, toxic int")).collect() == []


def test_held_out_rows_teach_nothing(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "string(id) AS text")
    labels = spark.range(100).selectExpr("id AS doc_id", "1 AS toxic")
    taught = {int(r.text) for r in toxicity.labelled(docs, labels).collect()}
    assert taught == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5}


def test_labels_that_differ_teach_nothing(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "string(id) AS text")
    labels = docs.selectExpr("doc_id", "1 AS toxic").union(docs.selectExpr("doc_id", "1 AS toxic")).union(docs.where("doc_id < 20").selectExpr("doc_id", "0 AS toxic"))
    taught = [int(r.text) for r in toxicity.labelled(docs, labels).collect()]
    assert sorted(taught) == [i for i in range(20, 40) if zlib.crc32(str(i).encode()) % 5]


@pytest.mark.parametrize("each", [1, 7, 500])
def test_samples_are_the_lowest_hashes_of_every_group(spark, each):
    rows = [(f"text {i % 900}", None if i % 11 == 0 else f"g{i % 3}") for i in range(3000)] + [("only one", "rare")] * 5
    frame = spark.createDataFrame(rows, "text string, lang string")
    got = {(r.lang, r.text) for r in hash_sample(frame, "lang", each).collect()}
    keyed = frame.distinct().withColumn("key", F.xxhash64("text")).collect()
    expected = set()
    for lang in {r.lang for r in keyed}:
        expected |= {(lang, r.text) for r in sorted((r for r in keyed if r.lang == lang), key=lambda r: r.key)[:each]}
    assert got == expected


def test_thousands_of_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: letters[i % 26] + letters[i // 26 % 26] + letters[i // 676]
    rows = [(f"{word(i)} {word(i)} {n}", f"l{i:04d}") for i in range(5000) for n in ("", "x")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    sample = hash_sample(frame, "lang", 1)
    assert sample.count() == sample.select("lang").distinct().count() == 5000
    words = language.codewords(5000)
    assert words.shape[0] == 5000 and len({tuple(row) for row in words}) == 5000
    model = language.train(frame.where("lang < 'l0060'"), sample=60)
    assert len(model.languages) == 60
    assert model.answer(f"{word(7)} {word(7)}")[0] in model.languages


@needs_tables
def test_toxicity_on_held_out_rows(spark):
    found = queries.QUERIES["op2_toxicity"](spark, SF)
    labels = queries.table(spark, SF, "labels").select("doc_id", "toxic")
    judged = found.join(labels, "doc_id").where("held_out").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("blamed")
    )
    row = judged.first()
    assert row.caught > 0.75 and row.blamed < 0.06
    assert found.where("score < 0 OR score > 1").count() == 0


@pytest.mark.parametrize("languages", [2, 3, 4, 6, 9, 20])
def test_codewords_are_far_apart(languages):
    words = language.codewords(languages)
    apart = [(words[a] != words[b]).sum() for a in range(languages) for b in range(a)]
    assert min(apart) >= (1 if languages == 2 else words.shape[1] / 4)
    assert all(abs(column.sum()) < languages for column in words.T)


def test_wrong_bits_are_corrected():
    words = language.codewords(4)
    model = language.Model(list("abcd"), words, np.eye(words.shape[1]), np.zeros(words.shape[1]), np.ones_like(words))
    for k in range(4):
        margins = 3 * words[k]
        margins[0] *= -1
        assert model.decode(margins[None])[0].argmax() == k


def test_language_of_messy_rows(spark):
    training = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chien et la vache", "fr"), ("nothing", None), (None, "en"), ("123", "de")] * 3, "text string, lang string"
    )
    model = language.train(training)
    rows = messy(spark).select("doc_id", "text", language.detect(model, "text").alias("found")).collect()
    for r in rows:
        assert (r.found.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.found.score <= 1
    assert model.answer("the dog and the cow")[0] == "en" and model.answer("die Katze und der Hund")[0] == "de"


def test_language_without_or_with_one_language(spark):
    schema = "text string, lang string"
    assert language.train(spark.createDataFrame([], schema)).answer("text") == ("und", 0.0, True)
    assert language.train(spark.createDataFrame([("text", "en")], schema)).answer("other")[:2] == ("en", 1.0)


@needs_tables
def test_language_on_held_out_rows(spark):
    found = queries.QUERIES["op3_language_id"](spark, SF).join(queries.table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
