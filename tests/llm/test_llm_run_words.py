import re

import pytest
from messy import messy
from pyspark.sql import functions as F

from cityloom.llm.runs import line_words, without_repeated_runs

#: The scripts by Python's own tables, for the texts below.
SPACELESS = re.compile(r"[฀-࿿က-႟ក-៿、-ㄯ㐀-鿿ｦ-ﾟ\U00020000-\U0003ffff]")

LINES = [
    "", " ", "\t", "\u3000 \u00a0\t\r", "one", " one  two ", "one\ttwo\tthree", "one\u00a0two\u2009three\u3000four", "end of line\r", "a\u200bb",
    "漢字かな", "abc漢字def ghi", "สวัสดีครับ", "ကမ္ဘာ မြန်မာ", "한국어 낱말 셋", "école déjà vu", "\U00020000\U00020001 x", "日本語。", "😀 smile 😀",
]


def counted(line):
    spaced = SPACELESS.sub(lambda m: f" {m.group()} ", line.replace("\u200b", " "))
    return len(spaced.split())


def test_words_of_lines(spark):
    rows = spark.createDataFrame(list(enumerate(LINES)), "n int, line string").select("n", line_words(F.col("line")).alias("words")).collect()
    assert {r.n: r.words for r in rows} == {n: counted(line) for n, line in enumerate(LINES)}


@pytest.mark.parametrize(
    "passage",
    [
        "\t".join(f"field{i}" for i in range(60)),
        "\u00a0".join(f"word{i}" for i in range(60)),
        "\u3000".join(f"word{i}" for i in range(60)),
        "\n".join("漢字文章" + chr(0x4E00 + i) for i in range(40)),
        "\n".join("สวัสดี" + chr(0x0E01 + i) for i in range(40)),
        "\r\n\r\n".join(f"line {i} of a text" for i in range(15)),
    ],
)
def test_passages_of_over_50_words_stay_once(spark, passage):
    rows = {r.doc_id: r.text for r in without_repeated_runs(messy(spark, [(1, passage), (2, f"head\n{passage}\ntail"), (3, "other")])).collect()}
    assert rows == {1: passage, 2: "head\ntail", 3: "other"}


def test_passages_below_50_words_stay(spark):
    passages = ["\t".join(f"field{i}" for i in range(49)), "漢" * 49]
    for passage in passages:
        rows = without_repeated_runs(messy(spark, [(1, passage), (2, passage)])).collect()
        assert [r.text for r in rows] == [passage, passage]
