"""Benchmark decontamination with a positional inverted index.

The index holds one posting (document, position, term) for every token of the documents that some test item contains; no test could ask for the
lists of other terms. Test items are cut into windows. A window's terms are ranked by the length of their posting lists; the postings of its rarest
term give the places where it may begin, and these are intersected with the postings of its next rarest terms, shifted by their offset in the
window. The few places that remain are compared word by word with the document.

Nothing about the documents is broadcast. Term and window tables are, if measured to be small, and are joined by shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityloom.llm.common import ascii_lower, packed, same, size_guarded, text_of
from cityloom.session import stage

#: What stands between words once A-Z are in lower case: ASCII other than digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Posting lists intersected before the words are compared.
PROBES = 3

_KEY = ("doc_id", "text_key")
_MATCHES = "array<struct<start:int,len:int,window_id:bigint>>"


def words_of(text: str | Column) -> Column:
    """The words of a text as an array; NULL has none."""
    return F.array_remove(F.split(ascii_lower(text_of(text)), SEPARATORS), "")


def item_windows(items: DataFrame, window: int = WINDOW, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Distinct windows of the items: ``window_id``, ``len``, ``terms`` and the ids, as strings, of the items that hold them.

    An item of fewer words than a window is one window; one without words has none. A NULL id is the empty string.
    """
    worded = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words_of(text_column).alias("words"))
    cut = worded.where(F.size("words") > 0).withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))))
    phrases = cut.select("item", F.slice("words", F.col("start") + 1, window).alias("terms"))
    held = phrases.groupBy("terms").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return stage(held.select(F.monotonically_increasing_id().alias("window_id"), F.size("terms").alias("len"), "terms", "items"), "windows")


def vocabulary(windows: DataFrame) -> DataFrame:
    """The terms of the windows, numbered."""
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    return stage(terms.select("term", F.monotonically_increasing_id().alias("term_id")), "vocabulary")


def build_index(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The positional index over whole texts: a stored table (doc_id, text_key, pos, term_id).

    A document is named by its id and a hash of its text, so rows that repeat an id stay apart.
    """
    tokens = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("text_key"), F.posexplode(words_of(text_column)).alias("pos", "term")
    )
    return stage(tokens.join(size_guarded(terms), "term").select(*_KEY, "pos", "term_id"), "postings")


def ranked_terms(index: DataFrame, windows: DataFrame, terms: DataFrame) -> DataFrame:
    """Each window's distinct terms (window_id, len, rank, offset, term_id, distinct_terms), the one with the shortest list first.

    Windows with a term that no document has are left out: they cannot occur.
    """
    lengths = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("postings"))
    known = size_guarded(stage(terms.join(lengths, "term_id"), "dictionary"))
    spread = windows.select("window_id", "len", F.posexplode("terms").alias("offset", "term")).join(known, "term", "left")
    firsts = spread.groupBy("window_id", "len", "term").agg(
        F.min("offset").alias("offset"), F.first("term_id").alias("term_id"), F.first("postings").alias("postings")
    )
    within = Window.partitionBy("window_id")
    ranked = firsts.withColumns(
        {
            "rank": F.row_number().over(within.orderBy("postings", "term")),
            "found": F.count("postings").over(within),
            "distinct_terms": F.count("term").over(within),
        }
    )
    return stage(
        ranked.where("found = distinct_terms").select("window_id", "len", "rank", "offset", "term_id", "distinct_terms"), "ranked"
    )


def candidates(index: DataFrame, ranked: DataFrame, probes: int = PROBES) -> DataFrame:
    """Places (document, window_id, start) at which the ``probes`` rarest terms of a window all stand where it needs them."""
    rarest = size_guarded(stage(ranked.where("rank = 1").select("window_id", "offset", "term_id"), "rarest"))
    found = index.join(rarest, "term_id").where("pos >= offset").select(*_KEY, "window_id", (F.col("pos") - F.col("offset")).alias("start"))
    for probe in range(2, probes + 1):
        # A window of fewer distinct terms is probed with its last one again.
        step = stage(ranked.where(F.col("rank") == F.least(F.lit(probe), "distinct_terms")).select("window_id", "offset", "term_id"), "probe")
        asked = found.join(size_guarded(step), "window_id").withColumn("pos", F.col("start") + F.col("offset"))
        lists = index.join(size_guarded(stage(step.select("term_id").distinct(), "asked")), "term_id", "left_semi")
        found = asked.join(lists, same(asked, lists, *_KEY, "pos", "term_id"), "left_semi").select(*_KEY, "window_id", "start")
    return found


def find_phrases(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    probes: int = PROBES,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    windows: DataFrame | None = None,
) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``text_key`` (a hash of the text) and a struct ``phrases`` with ``n_words``, ``matches``, an array of (start, len, window_id) for every exact occurrence of
    a window, and ``items``, the sorted ids of the items that hold one of these windows, each once.

    NULL and empty texts have no words and no matches; empty
    items match nothing; with an empty table of items there are no matches. Rows equal in id and text get equal results; NULL ids are ids like others. ``windows`` may be given where the caller has them.
    """
    windows = item_windows(items, window, item_id_column, item_text_column) if windows is None else windows
    terms = vocabulary(windows)
    index = build_index(docs, terms, id_column, text_column)
    places = candidates(index, ranked_terms(index, windows, terms), probes)
    places = places.join(size_guarded(windows.select("window_id", "len", "terms")), "window_id")
    per_doc = places.groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.struct("start", "len", "window_id", "terms"))).alias("places"))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("text_key"), F.col(text_column).alias("text"))
    asked = texts.join(per_doc, same(texts, per_doc, *_KEY), "left").select(texts["*"], "places")

    def compare(words: Column) -> Column:
        equal = F.filter("places", lambda p: F.slice(words, p["start"] + 1, p["len"]) == p["terms"])
        matches = F.transform(equal, lambda p: F.struct(p["start"].alias("start"), p["len"].alias("len"), p["window_id"].alias("window_id")))
        return F.struct(F.size(words).cast("bigint").alias("n_words"), F.coalesce(matches, F.array().cast(_MATCHES)).alias("matches"))

    # The one-element array binds the words once for all comparisons.
    compared = F.transform(F.array(words_of("text")), compare)[0]
    found = stage(asked.select(*_KEY, compared.alias("found")), "matches")
    # Windows that occur, each once for a document, and what items hold them: never an item list for a place.
    occurring = found.where(F.size("found.matches") > 0).select(*_KEY, F.explode(F.array_distinct("found.matches.window_id")).alias("window_id")).distinct()
    named = occurring.join(size_guarded(windows.select("window_id", "items")), "window_id").select(*_KEY, F.explode("items").alias("item")).distinct()
    per_doc_items = stage(named.groupBy(*_KEY).agg(F.sort_array(F.collect_list("item")).alias("items")), "hit-items")
    listed = size_guarded(per_doc_items)
    joined = found.join(listed, same(found, listed, *_KEY), "left").select(found["*"], "items")
    return joined.select(*_KEY, F.struct("found.n_words", "found.matches", F.coalesce("items", F.array().cast("array<string>")).alias("items")).alias("phrases"))


def with_phrases(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", result: str = "phrases", **options) -> DataFrame:
    """``docs`` with the struct ``phrases`` of ``find_phrases``, which has the ``options``. All columns and rows of ``docs`` stay; a column named like the result is replaced."""
    found = find_phrases(docs, items, id_column=id_column, text_column=text_column, **options).dropDuplicates([*_KEY])
    rows = packed(docs.drop(result), id_column, text_column)
    return rows.join(found, same(rows, found, *_KEY), "left").select("row.*", F.col("phrases").alias(result))


def hit_words(matches: Column) -> Column:
    """How many words lie inside at least one match."""
    covered = F.transform(matches, lambda m: F.sequence(m["start"], m["start"] + m["len"] - 1))
    return F.size(F.array_distinct(F.flatten(covered))).cast("bigint")


def without_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with their columns."""
    found = find_phrases(docs, items, id_column=id_column, text_column=text_column, **options)
    # Texts are shuffled once more only where the documents that go are too many for a broadcast.
    gone = size_guarded(stage(found.where(F.size("phrases.matches") > 0).select(*_KEY).distinct(), "contaminated"))
    rows = packed(docs, id_column, text_column)
    return rows.join(gone, same(rows, gone, *_KEY), "left_anti").select("row.*")


def proximity_matches(index: DataFrame, ranked: DataFrame, slop: int) -> DataFrame:
    """Where all distinct terms of a window stand close to its rarest term: (doc_id, text_key, window_id, pos).

    Close is at most len - 1 + ``slop`` words away, in any order. Positions are binned by the largest reach, so each anchor meets only the postings of
    its own bin and the two beside it.
    """
    widest = ranked.agg(F.max("len")).first()[0] or 1
    reach = widest - 1 + slop
    bins = max(reach, 1)
    anchor_terms = size_guarded(stage(ranked.where("rank = 1").select("window_id", "len", "term_id", "distinct_terms"), "anchors"))
    anchors = index.join(anchor_terms, "term_id").select(*_KEY, "window_id", "len", "distinct_terms", F.col("pos").alias("at"))
    alone = anchors.where("distinct_terms = 1").select(*_KEY, "window_id", "at")
    others = size_guarded(stage(ranked.where("rank > 1").select("window_id", "term_id"), "others"))
    wanted = anchors.join(others, "window_id").withColumn("bin", F.explode(F.array(*(F.floor(F.col("at") / bins) + i for i in (-1, 0, 1)))))
    lists = index.select(
        F.col("doc_id").alias("in_doc"), F.col("text_key").alias("in_text"), F.col("term_id").alias("met"), F.col("pos").alias("place")
    ).withColumn("near", F.floor(F.col("place") / bins))
    here = F.col("doc_id").eqNullSafe(F.col("in_doc")) & F.expr("text_key = in_text AND term_id = met AND bin = near")
    met = wanted.join(lists, here).where(F.abs(F.col("place") - F.col("at")) <= F.col("len") - 1 + slop)
    met = met.select(*_KEY, "window_id", "at", "distinct_terms", "term_id").distinct()
    full = met.groupBy(*_KEY, "window_id", "at", "distinct_terms").agg(F.count(F.lit(1)).alias("met")).where("met = distinct_terms - 1")
    return alone.union(full.select(*_KEY, "window_id", "at")).withColumnRenamed("at", "pos")
