"""Documents to tokens: drop what has no language, near copies and personal data, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes what a stage returns as
Parquet to the folder of spark.checkpoint.dir and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.byte_bpe import encode_documents
from tablewright.llm.common import materialize, table, take
from tablewright.llm.filter_audit import without
from tablewright.llm.jaccard_join import jaccard_groups
from tablewright.llm.language_id import in_a_language, learn_levels, learn_whole_profiles
from tablewright.llm.mixing import repeat_rows
from tablewright.llm.pseudonyms import pseudonym_column
from tablewright.llm.queries import KEY, RANKS


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that can't clash, and the name each needed column got."""
    columns = docs.columns
    names = [f"c{i}" for i in range(len(columns))]
    return docs.toDF(*names), {c: names[columns.index(c)] for c in ("doc_id", "text", "lang", "source")}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach.

    Those without a text or a letter are rejected, and so are those in no
    language that is taught: their n-grams are less than half as frequent in
    each one as those of 99 % of its labelled texts of that length.
    """
    profiles = learn_whole_profiles(docs)
    levels = learn_levels(docs, profiles)
    plain, at = _plain(docs)
    return plain.filter(in_a_language(F.col(at["text"]), profiles, levels)).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Five-word shingles, Jaccard similarity of 0.8 or more. Rows that repeat a
    doc_id or have none are told apart by number: of those with the smallest
    doc_id the first row stays, and nameless rows come last.
    """
    ids = take(docs, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("n > 1 OR doc_id IS NULL").isEmpty():
        groups = materialize(jaccard_groups(docs, percent=80, size=5), "near-copies")
        plain, at = _plain(docs)
        own = F.col(at["doc_id"])
    else:
        plain, at = _plain(docs)
        # the numbers are written down with their rows, so that every later read finds the same ones
        plain = materialize(plain.withColumn("number", F.monotonically_increasing_id()), "numbered")
        name = F.col(at["doc_id"])
        own = F.struct(name.isNull().alias("nameless"), name.alias("name"), F.col("number"))
        rows = plain.select(own.alias("doc_id"), F.col(at["text"]).alias("text"))
        groups = materialize(jaccard_groups(rows, percent=80, size=5), "near-copies")
        groups = groups.select(F.col("doc_id.number").alias("doc_id"), F.col("component_id.number").alias("component_id"))
        own = F.col("number")
    # few rows go, so most texts needn't be shuffled to tell that they stay
    gone = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("gone"))
    kept = without(plain, own, gone)
    return kept.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal numbers, dates and addresses; n_chars stays as it came."""
    plain, at = _plain(docs)
    new = pseudonym_column(F.col(at["text"]), KEY).getField("text")
    return plain.withColumn(at["text"], new).toDF(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    return repeat_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of every row of the mix."""
    return encode_documents(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("private", private),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Profiles, Feistel rounds and merges have no form in SQL; a brute-force version checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
