import re
from collections import defaultdict

import pytest
from messy import CASES, empty, messy, random_texts

from cityloom.llm import phrases
from pyspark.sql import functions as F


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def windows(items, size):
    found = defaultdict(set)
    for i, text in items:
        w = words(text)
        for at in range(max(len(w) - size, 0) + 1 if w else 0):
            found[tuple(w[at : at + size])].add("" if i is None else str(i))
    return found


def matches(text, wanted):
    w = words(text)
    return sorted(
        (at, len(terms), tuple(sorted(ids))) for terms, ids in wanted.items() for at in range(len(w) - len(terms) + 1) if tuple(w[at : at + len(terms)]) == terms
    )


@pytest.mark.parametrize(("probes", "window"), [(1, 4), (3, 4), (5, 2)])
def test_matches_equal_brute_force(spark, probes, window):
    cases = CASES + [(50 + i, t) for i, t in enumerate(random_texts(2, 60, 6, 40))]
    items = [(1, "w1 w2 w3 w4 w0 w5"), (2, "W1 w1 w2"), (3, "the quick BROWN fox jumps"), (4, ""), (5, None), (None, "one"), (6, "w9 none"), (6, "w0 w0 w0 w0"), (7, "école 漢字")]
    wanted = windows(items, window)
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    docs = messy(spark, cases).withColumn("phrases", F.lit("old"))
    cut = phrases.item_windows(benchmark, window)
    held = {r.window_id: tuple(r["items"]) for r in cut.collect()}
    found = phrases.with_phrases(docs, benchmark, window=window, probes=probes, windows=cut)
    assert found.columns == docs.columns
    rows = found.select("doc_id", "text", "row", "phrases", phrases.hit_words("phrases.matches").alias("n_hit")).collect()
    assert len(rows) == len(cases)
    for r in rows:
        expected = matches(r.text, wanted)
        assert sorted((m.start, m.len, held[m.window_id]) for m in r.phrases.matches) == expected
        assert r.phrases["items"] == sorted({i for _, _, ids in expected for i in ids})
        assert r.phrases.n_words == len(words(r.text))
        assert r.n_hit == len({p for start, n, _ in expected for p in range(start, start + n)})


def test_a_popular_window_costs_no_item_list_for_each_place(spark, monkeypatch):
    phrase = " ".join(f"p{i}" for i in range(10))
    items = spark.createDataFrame([(i, phrase) for i in range(300)], "item_id int, text string")
    docs = spark.createDataFrame([(i, " and ".join([phrase] * 30)) for i in range(20)], "doc_id int, text string")
    staged = {}
    inner = phrases.stage
    monkeypatch.setattr(phrases, "stage", lambda df, label: staged.setdefault(label, inner(df, label)))
    rows = phrases.with_phrases(docs, items).collect()
    assert all(len(r.phrases.matches) == 30 and r.phrases["items"] == sorted(str(i) for i in range(300)) for r in rows)
    matches = staged["matches"].schema["found"].dataType["matches"].dataType.elementType
    assert matches.names == ["start", "len", "window_id"] and staged["hit-items"].count() == 20


def test_contaminated_rows_go_with_all_columns(spark):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id int, text string")
    docs = messy(spark)
    clean = phrases.without_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum("quick" not in (t or "") for _, t in CASES)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert phrases.with_phrases(empty(spark), items).collect() == []
    rows = phrases.with_phrases(messy(spark), items.limit(0)).collect()
    assert len(rows) == len(CASES) and all(r.phrases.matches == [] == r.phrases["items"] for r in rows)


@pytest.mark.parametrize("slop", [0, 3])
def test_proximity_equals_brute_force(spark, slop):
    texts = random_texts(3, 25, 7, 30)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    items = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4 w4"), (3, "w5 w6 w5 w0"), (4, "w1 gone")], "item_id int, text string")
    wanted = phrases.item_windows(items, 4)
    terms = phrases.vocabulary(wanted)
    index = phrases.build_index(docs, terms)
    ranked = phrases.ranked_terms(index, wanted, terms)
    got = {(r.doc_id, r.window_id, r.pos) for r in phrases.proximity_matches(index, ranked, slop).collect()}
    names = {r.term_id: r.term for r in terms.collect()}
    anchors = {r.window_id: names[r.term_id] for r in ranked.where("rank = 1").collect()}
    expected = set()
    for r in wanted.collect():
        for i, text in enumerate(texts):
            w = words(text)
            for at, word in enumerate(w):
                reach = w[max(0, at - r.len + 1 - slop) : at + r.len + slop]
                if word == anchors.get(r.window_id) and set(r.terms) <= set(reach):
                    expected.add((i, r.window_id, at))
    assert got == expected and got


def test_no_python_in_the_plan(spark):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id int, text string")
    plan = phrases.with_phrases(messy(spark), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
