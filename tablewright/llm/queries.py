"""The operators of this package on the test tables, and the SQL that can check them."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.byte_bpe import digest_documents
from tablewright.llm.common import table
from tablewright.llm.decision_list import judge_quality
from tablewright.llm.embedding_dedup import near_duplicates
from tablewright.llm.filter_audit import audit_filters
from tablewright.llm.jaccard_join import jaccard_groups
from tablewright.llm.language_id import identify_languages
from tablewright.llm.lattice_lm import score_texts
from tablewright.llm.licenses import scan_licenses
from tablewright.llm.line_dedup import kept_lines, line_bitmaps
from tablewright.llm.mixing import mix_sources
from tablewright.llm.pseudonyms import pseudonymize
from tablewright.llm.sharding import shard_by_bytes
from tablewright.llm.spelling import MIN_CHARS, count_words, letter_runs, slipped, spelling_forms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The byte-level vocabulary, and the one whose scores weigh segmentations.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Key of the pseudonyms; a real run passes its own secret.
KEY = "tablewright"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def remainder(of: int, is_: int) -> Column:
    """Whether the crc32 of doc_id, as text, leaves this remainder. A null doc_id counts as the text ``null``."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % of == is_


@query
def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


@query
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"), remainder(3, 1))


@query
def op4_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), remainder(7, 2), PIECES, learn=True)


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("spans")


@query
def op6_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymize(table(spark, folder, "documents"), KEY)


@query
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digest_documents(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


@query
def op10_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"))


@query
def op11_spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    runs = letter_runs(table(spark, folder, "documents"))
    # a slip only makes a run shorter
    runs = runs.filter(F.char_length("run") >= MIN_CHARS)
    words = count_words(runs.select(slipped(F.col("doc_id"), F.col("run")).alias("word")))
    return spelling_forms(words)


@query
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    kept = kept_lines(docs, line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLES["op2_source_mix"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS hash
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2.0::DOUBLE * source_size AS ceiling,
           CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
    FROM sources
), levels AS (
    SELECT *, ceiling / weight AS full_at,
           (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(ceiling) OVER fuller, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER fuller, 0)) AS level_left
    FROM weighed
    WINDOW fuller AS (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           least(ceiling, coalesce(max(CASE WHEN level_left <= full_at THEN level_left END) OVER (), 'inf'::DOUBLE) * weight)
               AS target
    FROM levels
), running AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size / 2.0
               AS middle
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""

# crc32 has no function there: its table by the rule of its polynomial, then byte by byte
ORACLES["op11_spelling_forms"] = r"""
WITH RECURSIVE bits(i, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
), counted AS (
    SELECT doc_id, run, count(*) AS times,
           flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run, ''), lambda c:
               CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                    ELSE [CAST(192 + unicode(c) // 64 AS BIGINT), CAST(128 + unicode(c) % 64 AS BIGINT)] END)) AS bytes
    FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
    SELECT run, times, xor(4294967295, list_reduce(bytes, lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1]), 4294967295)) AS h
    FROM counted, crc
), slips AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                ELSE run END AS word, times
    FROM hashed
), words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slips WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), places AS (
    SELECT word, n, unnest(range(length(word))) AS i FROM words
), holes AS (
    SELECT word, n, substr(word, 1, i) || substr(word, i + 2) AS less, substr(word, 1, i) || '*' || substr(word, i + 2) AS hole
    FROM places
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word != b.word
    UNION
    SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.less = b.word
    UNION
    SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.less = b.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, {'less': -n, 'word': other}) AS other, max(n) AS most
    FROM pairs GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form,
           CASE WHEN most >= 2 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), chains(word, root) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT c.word, f.form FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON f.word = c.word JOIN formed e ON c.root = e.word AND e.form IS NULL
"""

ORACLES["op12_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.doc_id, k.pos, k.line, s.top IS NOT NULL AND k.doc_id != s.top AS dropped
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_ORDERS = ", ".join(f"'{''.join(p)}'" for p in permutations("ABCDE"))
_BITS = " + ".join(f"CASE WHEN contains({{0}}, '{c}') THEN {1 << i} ELSE 0 END" for i, c in enumerate("ABCDE"))

ORACLES["op13_filter_audit"] = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS words
    FROM documents
), flagged AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
    FROM texts
), counts AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS good, count(*) FILTER (WHERE l.toxic = 1) AS toxic
    FROM flagged f LEFT JOIN labels l ON f.doc_id = l.doc_id GROUP BY part, mask
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step,
           {_BITS.format("substr(filter_order, step, 1)")} AS bit, {_BITS.format("substr(filter_order, 1, step - 1)")} AS before
    FROM (SELECT unnest([{_ORDERS}]) AS filter_order), (SELECT unnest(range(1, 6)) AS step)
), removals AS (
    SELECT part, bit, sum(n) FILTER (WHERE mask & bit != 0 AND mask & before = 0) AS shapley FROM counts, steps GROUP BY part, bit
)
SELECT c.part, s.filter_order, s.step,
       CAST(coalesce(sum(n) FILTER (WHERE mask & (before | s.bit) = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (WHERE mask & s.bit != 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (WHERE mask & s.bit != 0 AND mask & before != 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (WHERE mask = s.bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (WHERE mask & s.bit != 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (WHERE mask & s.bit != 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(any_value(r.shapley), 0) AS BIGINT) AS shapley
FROM counts c, steps s JOIN removals r ON r.part = c.part AND r.bit = s.bit
GROUP BY c.part, s.filter_order, s.step
"""
