"""Group spelling variants: words one edit apart, by permuterm rotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, take

#: A run of letters, and what makes it a word: code points and occurrences.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
#: Marks the end of a word in its rotations; words that hold it are near nothing.
END = "\x00"
#: How many times as frequent as a word its form must be.
RATIO = 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def letter_runs(docs: DataFrame) -> DataFrame:
    """doc_id and run: every maximal run of letters of each text, A to Z in lower case, as often as it occurs.

    Null texts have none. Rows that repeat count each.
    """
    runs = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0)))
    rows = take(docs, "doc_id", "text").select("doc_id", runs.alias("run"))
    return rows.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))


def count_words(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of those long and frequent enough. Counted in each task first; nulls are left out."""
    long_enough = words.select("word").filter(F.char_length("word") >= min_chars)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """prefix, edited, n and head of all rotations of ``words`` (word, n), each word with its end mark.

    A rotation is there as a whole (``edited`` is empty), and without its last
    character, which then is ``edited``: what is left, the prefix, is the word
    from behind that character round to before it. All words that have another
    character there, or none, share the prefix. ``head``: the
    character isn't equal to the one before it, so that of equal neighbours
    only the first counts as left out.
    """
    words = words.filter(~F.contains("word", F.lit(END)))
    marked = F.concat(F.expr("substring(word, at + 1)"), F.lit(END), F.expr("substring(word, 1, at)"))
    rows = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("at"))
    rows = rows.select("n", "at", marked.alias("rotation"), F.expr("substring(word, at, 1)").alias("last"),
                       F.expr("at = 1 or substring(word, at - 1, 1) != substring(word, at, 1)").alias("head"))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit("").alias("edited"), F.lit(True).alias("head"))
    cut = F.struct(
        F.expr("substring(rotation, 1, char_length(rotation) - 1)").alias("prefix"),
        F.col("last").alias("edited"),
        F.col("head"),
    )
    both = F.explode(F.when(F.col("at") == 0, F.array(whole)).otherwise(F.array(whole, cut)))
    return rows.select(both.alias("r"), "n").select("r.prefix", "r.edited", "r.head", "n")


def near_words(words: DataFrame, parts: int | None = None) -> DataFrame:
    """word, n_near and best (n, word) of every one of ``words`` (word, n) that is near another.

    Near words differ by exactly one character inserted, deleted or replaced.
    The rotations of all words are sorted, dealt out by ranges of prefixes, so
    that the words of a prefix are neighbours in one task: at most one
    that is the prefix itself, and one for each character of the alphabet. They are
    each other's neighbours, and a pair is found in one place only. A word's
    row for each prefix says how many neighbours it has there and which is the
    most frequent; pairs are never written out.
    """
    spun = rotations(words)
    spun = spun.repartitionByRange(parts, "prefix") if parts else spun.repartitionByRange("prefix")
    ranges = spun.sortWithinPartitions("prefix", "edited").groupBy("prefix").agg(
        F.collect_list(F.struct("edited", "head", "n")).alias("members")
    )
    ranges = ranges.filter(F.size("members") > 1)

    def spelt(member: str) -> str:
        return f"concat(substring_index(prefix, char(0), -1), {member}.edited, substring_index(prefix, char(0), 1))"

    near = "x.edited != m.edited and (x.edited != '' or m.head) and (m.edited != '' or x.head)"
    rows = ranges.select("prefix", "members", F.explode("members").alias("m"))
    rows = rows.withColumn("near", F.expr(f"filter(members, x -> {near})")).filter("size(near) > 0")
    rows = rows.select(
        F.expr(spelt("m")).alias("word"),
        F.size("near").cast("long").alias("n_near"),
        # the most frequent first, then in code-point order
        F.expr(f"array_min(transform(near, x -> named_struct('less', -x.n, 'word', {spelt('x')})))").alias("best"),
    )
    best = rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.word")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: where the forms of ``forms`` (word, form) lead to in the end.

    Every round each word jumps to where its root points, so chains halve; a form is
    at least twice as frequent as its word, so they are short. Each round is
    written down.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "word-forms")
    while True:
        further = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = roots.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        jumped = materialize(jumped, "word-roots")
        roots = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return roots


def spelling_forms(words: DataFrame, ratio: int = RATIO, parts: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of ``words`` (word, n).

    A word's form is its most frequent near word (of equally frequent ones the
    first in code-point order) if that is ``ratio`` times (2 or more) as
    frequent, else null; root is where forms lead to, the word itself without
    a form. Words that repeat count together; null words and counts are left
    out, and an empty word is near those of one character. No words give no
    rows. Words may be of any length and alphabet; one that holds the end mark
    U+0000 is near nothing. Ties go by code points, so reruns agree.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    words = take(words, "word", "n").dropna().groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words, "words")
    near = near_words(words, parts).withColumnRenamed("word", "w")
    form = F.when(F.col("best.n") >= F.col("n") * ratio, F.col("best.word"))
    rows = words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), F.col("best.n")).alias("form_n"),
    )
    rows = materialize(rows, "near-words")
    roots = _roots(rows.filter("form is not null")).select(F.col("word").alias("w"), "root")
    return rows.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n")
    )


def slipped(doc_id: Column, run: Column, every: int = 97) -> Column:
    """The run, less one character where ``every`` divides the crc32 of doc_id and run: slips to be found again.

    A null doc_id counts as the text ``null``.
    """
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    h = F.crc32(F.concat(name, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, cut).otherwise(run)
