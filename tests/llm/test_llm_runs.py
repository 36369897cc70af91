import duckdb
import pytest
from messy import CASES, empty, messy, random_texts
from test_llm_run_words import counted

from cityloom.llm.runs import without_repeated_runs
from pyspark.sql import functions as F


def shorter(cases, least):
    """Brute force: every run of at least ``least`` words that begins earlier somewhere loses its lines."""
    docs = []
    for i, text in cases:
        lines = (text or "").split("\n")
        docs.append((i, text, [n for n, line in enumerate(lines) if counted(line)], lines))
    order = sorted({(i is not None, i or 0, text or "") for i, text, _, _ in docs})
    first, removed = {}, [set() for _ in docs]
    # Documents with equal ids are ordered by a hash that is not rebuilt here: the cases have different ids or equal texts.
    for key in order:
        members = [n for n, (i, text, _, _) in enumerate(docs) if (i is not None, i or 0, text or "") == key]
        _, _, filled, lines = docs[members[0]]
        gone = set()
        for a in range(len(filled)):
            run, words = (), 0
            for b in range(a, len(filled)):
                run += (lines[filled[b]],)
                words += counted(run[-1])
                if words >= least:
                    if run in first:
                        gone |= set(range(a, b + 1))
                    first.setdefault(run, (key, a))
        lost = {filled[p] for p in gone}
        for p in gone & {p - 1 for p in gone}:
            lost |= set(range(filled[p], filled[p + 1]))
        for n in members:
            removed[n] = lost
    return [None if text is None else "\n".join(line for n, line in enumerate(lines) if n not in removed[k]) for k, (_, text, _, lines) in enumerate(docs)]


SMALL = [(i, t) for i, t in CASES if len(t or "") < 1000]


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 5), (3, 1)])
def test_texts_equal_brute_force(spark, seed, least):
    texts = [t.replace("w1", "w1 and more").replace("w2", "") for t in random_texts(seed, 40, 5, 14, lines=True)]
    cases = [*SMALL[:6], *((20 + i, t) for i, t in enumerate(texts))]
    docs = messy(spark, cases).withColumn("removed_lines", F.lit(1))
    got = without_repeated_runs(docs, min_words=least)
    assert set(got.columns) == set(docs.columns)
    assert sorted(((r.text_key, r.text) for r in got.collect()), key=str) == sorted(enumerate(shorter(cases, least)), key=str)


def test_sql_has_the_same_rule(spark, tmp_path):
    from cityloom.llm import queries

    tabs = ["\t".join(f"field{i}.{n}" for i in range(60)) for n in range(12)]
    chinese, blank = "漢字" * 30, "\u3000\t "
    cases = [(1, "\n".join(tabs)), (2, "\n".join(["head", *tabs[:6], blank, *tabs[6:]])), (3, f"a\n{chinese}"), (4, f"{chinese}\nb"), (5, "one\u00a0two " * 30), (6, "x\n" + "one\u00a0two " * 30), (7, None), (8, "สวัสดี" * 9), (9, "สวัสดี" * 9)]
    spark.createDataFrame(cases, "doc_id int, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in queries.QUERIES["op5_line_dedup"](spark, str(tmp_path)).select("doc_id", "n_lines", "n_removed", "text_sha256").collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(connection.execute(queries.SQL["op5_line_dedup"]).fetchall())
    assert [n for _, _, n, _ in got] == [0, 13, 0, 1, 0, 1, 0, 0, 1]


def test_long_copies_leave_the_first_alone(spark):
    body = "\n".join(f"line {i} of a long text" for i in range(400))
    cases = [(3, body), (1, f"head\n{body}\ntail"), (2, body), (9, "short")]
    rows = {r.doc_id: r for r in without_repeated_runs(messy(spark, cases)).collect()}
    assert rows[1].text == cases[1][1] and rows[2].text == "" and rows[3].text == "" and rows[9].text == "short"
    assert [(r.first, r.last) for r in rows[2].removed_lines] == [(0, 399)]


def test_a_text_that_repeats_itself(spark):
    cases = [(1, "\n".join(["the very same line again"] * 30))]
    row = without_repeated_runs(messy(spark, cases), min_words=10).first()
    assert row.text == "the very same line again"


def test_empty_table(spark):
    assert without_repeated_runs(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = without_repeated_runs(messy(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
