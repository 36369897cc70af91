"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityloom.llm import counts, exact, language, licenses, merkle, periodic, phrases, pieces, runs, shards, simhash, token_files, toxicity
from cityloom.llm.common import ascii_lower, importable, sized_shuffles, text_of
from cityloom.session import scratch_dir, stage

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
MOST_TOKENS = 2048

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            with sized_shuffles(table(spark, sf_dir, "documents")):
                return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = dedent(sql).strip()
        return function

    return register


def vocabulary_path(name: str) -> str:
    """Place of a vocabulary file of the installed package of public tokenizers; it is the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op8_exact_dedup",
    r"""
    WITH keyed AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    ), ranked AS (
        SELECT *, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM keyed WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_copies(table(spark, sf_dir, "documents")).drop("may_repeat")


#: Checksum of each text, byte by byte over a table made from the polynomial; then the jumps, which stop after as many as there are shards.
_SHARDING_SQL = """
    WITH RECURSIVE lookup AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
    ), keyed AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
            xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
        FROM documents, lookup
    ), jumps AS (
        SELECT doc_id, n, -1::BIGINT AS b, 0::BIGINT AS j, doc_id::HUGEINT AS k FROM documents, (VALUES (16), (17)) AS counts(n)
        UNION ALL
        SELECT doc_id, n, j, floor((j + 1) * (2147483648::DOUBLE / ((next_k // 8589934592) + 1)::DOUBLE))::BIGINT, next_k
        FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS next_k FROM jumps WHERE j < n)
    ), placed AS (
        SELECT doc_id, max(b) FILTER (n = 16) AS shard, max(b) FILTER (n = 17) AS grown_shard FROM jumps GROUP BY doc_id
    )
    SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard::INT AS grown_shard
    FROM keyed JOIN placed USING (doc_id)
"""


@query("op9_sharding", _SHARDING_SQL)
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(table(spark, sf_dir, "documents"), 16).withColumn("law", F.lit("key"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.withColumn("fingerprint", simhash.hex_fingerprint())


@query(
    "op4_decontamination",
    r"""
    WITH items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), item_windows AS (
        SELECT DISTINCT item_id, least(len(words), 10) AS n, words[start + 1 : start + 10] AS terms
        FROM (SELECT *, unnest(range(greatest(len(words) - 10, 0) + 1)) AS start FROM items WHERE len(words) > 0)
    ), doc_windows AS (
        SELECT doc_id, start, n, words[start + 1 : start + n] AS terms
        FROM (SELECT doc_id, words, n, unnest(range(len(words) - n + 1)) AS start
            FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)
    ), found AS (
        SELECT doc_id, start, n, item_id FROM doc_windows JOIN item_windows USING (n, terms)
    ), hits AS (
        SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(start, start + n)) AS pos FROM found) GROUP BY doc_id
    ), hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.find_phrases(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    matches, items = F.col("phrases.matches"), F.col("phrases.items")
    return found.select(
        "doc_id",
        F.col("phrases.n_words").alias("n_words"),
        phrases.hit_words(matches).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(matches) > 0).alias("contaminated"),
    )


NEAR = 5


@query(
    "decontamination_near",
    rf"""
    WITH items AS (
        SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), windows AS (
        SELECT terms, len(terms) AS n, row_number() OVER () AS id FROM (
            SELECT DISTINCT words[start + 1 : start + 10] AS terms
            FROM (SELECT *, unnest(range(greatest(len(words) - 10, 0) + 1)) AS start FROM items WHERE len(words) > 0))
    ), wanted AS (SELECT DISTINCT id, n, unnest(terms) AS term FROM windows
    ), tokens AS (
        SELECT doc_id, pos, words[pos + 1] AS term FROM (SELECT doc_id, words, unnest(range(len(words))) AS pos FROM (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents)) WHERE words[pos + 1] IN (SELECT term FROM wanted)
    ), listed AS (SELECT term, count(*) AS postings FROM tokens GROUP BY term
    ), ranked AS (
        SELECT id, n, term, postings, row_number() OVER (PARTITION BY id ORDER BY postings, term) AS rank, count(*) OVER (PARTITION BY id) AS terms, count(postings) OVER (PARTITION BY id) AS found
        FROM wanted LEFT JOIN listed USING (term)
    ), anchors AS (
        SELECT doc_id, id, n, terms, pos AS place FROM ranked JOIN tokens USING (term) WHERE rank = 1 AND found = terms
    ), met AS (
        SELECT a.doc_id, a.id, a.place, a.terms, count(DISTINCT r.term) AS others
        FROM anchors a JOIN ranked r ON a.id = r.id AND r.rank > 1 JOIN tokens t ON t.doc_id = a.doc_id AND t.term = r.term AND abs(t.pos - a.place) <= a.n - 1 + {NEAR}
        GROUP BY a.doc_id, a.id, a.place, a.terms
    ), near AS (
        SELECT doc_id, id, place FROM met WHERE others = terms - 1 UNION SELECT doc_id, id, place FROM anchors WHERE terms = 1
    )
    SELECT doc_id, count(id) AS n_near, count(DISTINCT id) AS n_windows FROM documents LEFT JOIN near USING (doc_id) GROUP BY doc_id
    """,
)
def decontamination_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of each document at which all words of a benchmark window stand close together, in any order; exact matches are among them."""
    docs = table(spark, sf_dir, "documents")
    windows = phrases.item_windows(table(spark, sf_dir, "benchmark"))
    terms = phrases.vocabulary(windows)
    index = phrases.build_index(docs, terms)
    near = phrases.proximity_matches(index, phrases.ranked_terms(index, windows, terms), NEAR)
    counted = stage(near.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_near"), F.count_distinct("window_id").alias("n_windows")), "near")
    found = docs.select("doc_id").join(counted, "doc_id", "left")
    return found.select("doc_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("n_near", "n_windows")])


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path(PIECE_MODEL))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("piece_ids") / 4).alias("n_tokens"),
        F.sha2("piece_ids", 256).alias("ids_sha256"),
        F.sha2("piece_text", 256).alias("decoded_sha256"),
    )


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path(BYTE_TOKENIZER), end_id=2)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def _as_re2(pattern: str) -> str:
    """A character class of the operator in the spelling of the SQL's regular expressions; there, white space is less by itself."""
    return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern).replace(r"\s\p{Z}", r"\x{09}-\x{0D}\x{20}\p{Z}").replace(r"\x1C-\x1F\x85", r"\x{1C}-\x{1F}\x{85}")


_LINE_WORD, _LINE_FILLED = _as_re2(runs.WORD), _as_re2(runs.FILLED)


@query(
    "op5_line_dedup",
    rf"""
    WITH lines AS (
        SELECT doc_id, line_no, line, len(regexp_extract_all(line, '{_LINE_WORD}')) AS words,
            row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
            FROM documents)
        WHERE regexp_matches(line, '{_LINE_FILLED}')
    ), summed AS (
        SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lines
    ), listed AS (
        SELECT doc_id, list(line ORDER BY pos) AS texts FROM lines GROUP BY doc_id
    ), runs AS (
        SELECT a.doc_id, a.pos AS i, min(b.pos) AS j FROM summed a JOIN summed b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= 50
        GROUP BY a.doc_id, a.pos
        UNION
        SELECT a.doc_id, max(b.pos) AS i, a.pos AS j FROM summed a JOIN summed b ON a.doc_id = b.doc_id AND b.pos <= a.pos AND a.upto - b.upto + b.words >= 50
        GROUP BY a.doc_id, a.pos
    ), placed AS (
        SELECT doc_id, i, j, array_to_string(texts[i:j], chr(10)) AS content FROM runs JOIN listed USING (doc_id)
    ), later AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS copy FROM placed) WHERE copy > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS pos FROM later
    ), every_line AS (
        SELECT doc_id, line, line_no, regexp_matches(line, '{_LINE_FILLED}') AS filled, count(*) FILTER (regexp_matches(line, '{_LINE_FILLED}')) OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
            FROM documents)
    ), marked AS (
        SELECT e.*, g.pos IS NOT NULL AND (filled OR n.pos IS NOT NULL) AS removed
        FROM every_line e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos LEFT JOIN gone n ON e.doc_id = n.doc_id AND e.pos + 1 = n.pos
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT removed), '')) AS text_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("n_lines", F.size(F.split(text_of("text"), "\n")).cast("bigint"))
    shorter = runs.without_repeated_runs(docs)
    taken = F.aggregate("removed_lines", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    return shorter.select("doc_id", "n_lines", taken.alias("n_removed"), F.sha2(text_of("text"), 256).alias("text_sha256"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.toxic_score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", toxicity.held_out("doc_id").alias("held_out"))
    model = language.train(docs.where("NOT held_out").select("text", "lang"))
    return docs.select("doc_id", "held_out", language.detect(model, "text").alias("found")).select("doc_id", "held_out", "found.*")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"])))
    changed = F.filter("licenses", lambda x: x["status"] == "modified")
    return scanned.select(
        "doc_id",
        F.array_join(named, ",").alias("license_ids"),
        F.size("licenses").cast("bigint").alias("n_statements"),
        F.size(changed).cast("bigint").alias("n_modified"),
        F.array_max(F.transform("licenses", lambda x: x["saved"])).alias("best_saved"),
    )


#: The checksum of a decimal doc_id, byte by byte over a table made from the polynomial.
_ID_CRC32_SQL = """
    lookup AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
    ), checked AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS crc
        FROM documents, lookup
    )"""

_ENCODED_SQL = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
_LEAF_SQL = "sha256(" + " || ".join(_ENCODED_SQL.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"


@query(
    "op11_merkle_manifest",
    f"""
    WITH RECURSIVE {_ID_CRC32_SQL}, leaves AS (
        SELECT doc_id, lang, {_LEAF_SQL.format("text")} AS leaf,
            {_LEAF_SQL.format("CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS held
        FROM checked
    ), placed AS (
        SELECT *, {_ENCODED_SQL.format("lang")} AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
        FROM leaves
    ), nodes AS (
        SELECT part, 0 AS level, pos, n, leaf AS digest FROM placed
        UNION ALL
        SELECT part, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY part, level, pos // 8, n
    ), subroots AS (
        SELECT part, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM nodes JOIN (SELECT DISTINCT part, lang FROM placed) USING (part) WHERE n = 1
    ), upper_nodes AS (
        SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8, n
    ), runs AS (
        SELECT part, level, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM nodes WHERE n > 1 GROUP BY part, level, pos // 8
    ), upper_runs AS (
        SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8
    ), walk AS (
        SELECT doc_id, leaf, part, 0 AS level, pos, n, held AS folded, '' AS proof FROM placed
        UNION ALL
        SELECT doc_id, leaf, part, level + 1, pos // 8, (n + 7) // 8,
            sha256(array_to_string(digests[:pos % 8], '') || folded || array_to_string(digests[pos % 8 + 2:], '')),
            proof || array_to_string(digests[:pos % 8], '') || array_to_string(digests[pos % 8 + 2:], '')
        FROM walk JOIN runs USING (part, level) WHERE run = pos // 8
    ), upper_walk AS (
        SELECT doc_id, leaf, part, subroot, 0 AS level, s.pos, s.n, folded, proof FROM walk JOIN subroots s USING (part) WHERE walk.n = 1
        UNION ALL
        SELECT doc_id, leaf, part, subroot, level + 1, pos // 8, (n + 7) // 8,
            sha256(array_to_string(digests[:pos % 8], '') || folded || array_to_string(digests[pos % 8 + 2:], '')),
            proof || array_to_string(digests[:pos % 8], '') || array_to_string(digests[pos % 8 + 2:], '')
        FROM upper_walk JOIN upper_runs USING (level) WHERE run = pos // 8
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM upper_walk, (SELECT digest AS root FROM upper_nodes WHERE n = 1) WHERE n = 1
    """,
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    named = ["doc_id", "source", "lang", "n_chars"]
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest([*named, "text"]).alias("leaf"), merkle.leaf_digest([*named, held]).alias("held_leaf"))
    proofs = merkle.build(leaves, "lang", "doc_id").proofs()
    folded = proofs.withColumns({"folded_root": merkle.fold("path", F.col("held_leaf")), "proof_sha256": merkle.proof_digest("path")})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query(
    "op12_periodic_runs",
    rf"""
    WITH {_ID_CRC32_SQL}, split AS (
        SELECT row_number() OVER () AS id, doc_id, crc, crc // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS original FROM checked
    ), planned AS (
        SELECT *, len(original) AS n, g % len(original) AS a, 1 + (len(original) - g % len(original)) // (3 + g % 8) AS p FROM split
    ), docs AS (
        SELECT id, doc_id, n, CASE WHEN crc % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: original[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
            ELSE original END AS words
        FROM planned
    ), grams AS (
        -- A run's words agree with those a period on for 6 words at least.
        SELECT id, n, i, array_to_string(words[i + 1 : i + 6], ' ') AS gram FROM (SELECT id, n, words, unnest(range(n - 5)) AS i FROM docs WHERE n >= 12)
    ), pairs AS (
        SELECT x.id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.id = y.id AND x.gram = y.gram AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
    ), islands AS (
        SELECT id, q, min(i) AS start, count(*) + 5 + q AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM pairs) GROUP BY id, q, island
    ), runs AS (
        SELECT id, start, length, min(q) AS period FROM islands WHERE length >= greatest(12, 2 * q) GROUP BY id, start, length
    ), listed AS (
        SELECT id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS rows FROM runs GROUP BY id
    ), longest AS (
        SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY id ORDER BY length DESC, start, period) = 1
    ), dropped AS (
        SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM runs
    ), collapsed AS (
        SELECT id, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT id, unnest(words) AS word, unnest(range(n)) AS i FROM docs) ANTI JOIN dropped USING (id, i) GROUP BY id
    )
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
        sha256(coalesce(rows, '')) AS runs_sha256, sha256(coalesce(collapsed.text, '')) AS collapsed_sha256
    FROM docs LEFT JOIN listed USING (id) LEFT JOIN longest USING (id) LEFT JOIN collapsed USING (id)
    """,
)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A tenth of the texts is made periodic from a place on.
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(text_of("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    planned = docs.withColumns({"crc": crc, "words": F.when(crc % 10 == 0, words)}).withColumns({"n": F.size("words"), "g": F.floor(F.col("crc") / 10)})
    planned = planned.withColumn("a", F.expr("CAST(CASE WHEN n > 0 THEN g % n END AS INT)")).withColumn("p", F.expr("CAST(1 + floor((n - a) / (3 + g % 8)) AS INT)"))
    periodic_words = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a))")
    text = F.when(F.col("n") > 0, F.array_join(periodic_words, " ")).otherwise(F.col("text"))
    found = periodic.with_runs(planned.select("doc_id", text.alias("text")))
    each = F.transform("runs.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(each, lambda line: F.concat(line, F.lit("\n"))), "")
    named = found.select(
        "doc_id",
        F.size("runs.runs").cast("bigint").alias("n_runs"),
        periodic.longest("runs.runs").alias("best"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("runs.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return named.select("doc_id", "n_runs", "best.*", exponent, "runs_sha256", "collapsed_sha256")


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.with_token_counts(docs, vocabulary_path(WORD_TOKENIZER), MOST_TOKENS).select("doc_id", "n_bytes", "n_tokens", "over_limit")
