"""Readers for delimited, JSON and XML dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.functions.values import quoted
from tablewright.operators.cleaning import NA_TOKENS, normalize_na
from tablewright.operators.joins import union_by_name
from tablewright.operators.ranking import with_row_number
from tablewright.sources.delimited import CELL_OPTIONS, read_delimited

CSV_OPTIONS = {"header": "true", **CELL_OPTIONS}
#: Encodings in which a quote, a separator or a line feed may be part of another character.
_WIDE = ("utf-16", "utf-32", "utf16", "utf32")


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _badly_encoded_files(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """All files, split into valid UTF-8 and not.

    The text source hands over the bytes as they are and its files can be
    split, so one big file is checked by many tasks.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok")
    )
    verdicts = lines.groupBy("file").agg(F.min("ok").alias("ok")).collect()
    return (
        sorted(r["file"] for r in verdicts if r["ok"]),
        sorted(r["file"] for r in verdicts if not r["ok"]),
    )


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = "\t",
    encodings: Sequence[str] = ("utf-8", "ISO-8859-1"),
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = True,
    surplus: str | None = "raise",
) -> DataFrame:
    """Delimited text with a header, every column a string.

    Files that are not valid in the first encoding are read in the second: the
    first of ``encodings`` is UTF-8 then, and the second one that accepts any
    byte, so later ones are never reached. Files whose headers differ are
    each read under their own, columns a file lacks are null.

    The files are read once, in one scan that also learns headers and encodings,
    and large ones are cut for many tasks although quoted cells may hold line
    breaks (``delimited.read_delimited``, which also explains ``surplus``).
    ``multiline`` may be switched off for files known to have no breaks in cells:
    that saves writing the records down, but reads the files for their headers and,
    with two encodings, for these. Then, and in wide encodings, surplus cells are dropped.
    """

    def load(files: Sequence[str], encoding: str) -> DataFrame:
        reader = spark.read.options(**CSV_OPTIONS).option("sep", sep).option("encoding", encoding)
        reader = reader.option("multiLine", multiline)
        groups = _by_header(spark, files, encoding)
        return union_by_name([reader.csv(members) for members in groups] or [reader.csv(list(files))])

    paths = _paths(path)
    if multiline and not any(e.lower().startswith(_WIDE) for e in encodings[:2]):
        return normalize_na(read_delimited(spark, paths, sep, encodings, surplus=surplus), na_tokens)
    if len(encodings) == 1:
        return normalize_na(load(paths, encodings[0]), na_tokens)
    good, bad = _badly_encoded_files(spark, paths)
    parts = [load(files, code) for files, code in zip((good, bad), encodings[:2], strict=True) if files]
    return normalize_na(union_by_name(parts) if parts else load(paths, encodings[0]), na_tokens)


def read_typed_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: StructType | str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = True,
    surplus: str | None = "raise",
) -> DataFrame:
    """Delimited text with inferred types; a given ``schema`` saves the inferring scan.

    Texts that read as missing are null before types are inferred, so one
    ``NA`` doesn't turn a column of numbers into text. ``multiline`` and
    ``surplus`` as in ``read_text_table``; types are inferred from the records
    written down, not from the files.
    """
    if multiline:
        text = read_delimited(spark, [path], sep, surplus=surplus)
    else:
        text = spark.read.options(**CSV_OPTIONS).option("sep", sep).csv(path)
    text = normalize_na(text, na_tokens)
    if schema is None:
        schema = inferred_types(text)
    types = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if len(types) != len(text.columns):
        raise ValueError(f"{path} has {len(text.columns)} columns, the schema {len(types)}")
    named = text.toDF(*[f.name for f in types])
    return named.select(
        *[F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in types]
    )


_WHOLE = r"^[+-]?\d+$"
#: Types a column of text may turn out to have, narrowest first, and what their texts look like.
_TYPES = (
    ("int", _WHOLE),
    ("bigint", _WHOLE),
    ("decimal(38,0)", _WHOLE),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(NaN|Infinity|Inf)$"),
    ("boolean", r"^(?i)(true|false)$"),
    ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"),
)


def inferred_types(text: DataFrame) -> StructType:
    """The narrowest type that reads every value of each column; text if none does or there is no value.

    One aggregate counts, for each column and type, the values that don't read.
    """
    checks = []
    for i, name in enumerate(text.columns):
        value = F.col(quoted(name))
        checks.append(F.count(value).alias(f"n{i}"))
        for k, (kind, look) in enumerate(_TYPES):
            reads = value.rlike(look) & value.try_cast(kind).isNotNull()
            checks.append(F.count_if(value.isNotNull() & ~reads).alias(f"bad{i}_{k}"))
    row = text.agg(*checks).first() if checks else {}
    fields = []
    for i, name in enumerate(text.columns):
        fitting = [kind for k, (kind, _) in enumerate(_TYPES) if row[f"n{i}"] and not row[f"bad{i}_{k}"]]
        fields.append(f"{quoted(name)} {fitting[0] if fitting else 'string'}")
    return StructType.fromDDL(", ".join(fields)) if fields else StructType()


def read_csv_with_xml(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = True, surplus: str | None = "raise"
) -> DataFrame:
    """Comma-separated rows with quoted XML cells, every column a string.

    ``multiline`` and ``surplus`` as in ``read_text_table``; without ``multiline`` all files have one header.
    """
    if multiline:
        return read_delimited(spark, _paths(path), ",", surplus=surplus)
    return spark.read.options(**CSV_OPTIONS).csv(_paths(path))


def read_folder_union(
    spark: SparkSession, folder: str, suffix: str = ".tsv", multiline: bool = True, surplus: str | None = "raise"
) -> DataFrame:
    """All matching files of a folder; columns a file lacks are null.

    One scan reads all files and learns their headers; the cells of a record go
    where its file's header says. Without ``multiline`` (no line breaks in
    cells) files are grouped by header, and each group is a scan. ``surplus`` as in ``read_text_table``.
    """
    if multiline:
        return read_delimited(spark, [folder], ",", suffix=suffix, surplus=surplus)
    groups = _by_header(spark, [folder], suffix=suffix)
    if not groups:
        raise FileNotFoundError(f"no *{suffix} file with a header in {folder}")
    return union_by_name([read_csv_with_xml(spark, members, False) for members in groups])


def _by_header(
    spark: SparkSession, files: Sequence[str], encoding: str = "utf-8", suffix: str = ""
) -> list[list[str]]:
    """Files with equal header lines, together. One job, however many files there are.

    Files without a line are left out. Headers are compared as text, so two that differ
    in quoting alone only cost one scan more. A file whose header has a line break in quotes stays alone.
    """
    lines = (
        spark.read.option("encoding", encoding)
        .option("pathGlobFilter", f"*{suffix}")
        .text(list(files))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
        .where("trim(value) <> ''")
    )
    first = lines.groupBy("file").agg(F.min(F.struct("block", "place", "value")).alias("first"))
    groups: dict[str, list[str]] = {}
    for row in sorted(first.select("file", "first.value").collect(), key=lambda r: r["file"]):
        whole = row["value"].count('"') % 2 == 0
        groups.setdefault(row["value"] if whole else row["file"], []).append(row["file"])
    return list(groups.values())


def read_id_list(spark: SparkSession, path: str | Sequence[str], db: str | None = None) -> DataFrame:
    """``(db, id)`` from JSON arrays of IDs.

    A file is split where one ID ends and the next begins (quote, comma, quote),
    so that an array in one long line is read by many tasks; each piece is then
    decoded as JSON. Lists with blanks around their commas, or of numbers, are
    read line by line instead. Without ``db`` the name of the file's folder is taken.
    """
    paths = _paths(path)
    source = F.lit(db) if db is not None else F.element_at(F.split("_metadata.file_path", "/"), -2)
    whole = F.octet_length("value") == F.col("_metadata.file_size")
    pieces = spark.read.option("lineSep", '","').text(paths).select(source.alias("db"), "value", whole.alias("whole"))
    # an ID that ends in a quote and a comma was torn, too: such files are read as one piece each
    if not pieces.where(F.col("value").rlike(r"(?<!\\)(\\\\)*\\$")).isEmpty():
        pieces = spark.read.option("wholetext", True).text(paths).select(source.alias("db"), "value", F.lit(True).alias("whole"))
    value = F.col("value")
    # a piece lacks the quotes it was split at, unless a list begins or ends there
    begins = F.col("whole") | value.rlike(r'^\s*\[(\s*"|\s*\]\s*\n)')
    ends = F.col("whole") | value.rlike(r'((?<!\\)(\\\\)*"\s*\]|\n\s*\[\s*\])\s*$')
    text = F.concat(F.when(begins, "").otherwise('["'), value, F.when(ends, "").otherwise('"]'))
    # strings hold no raw line break, so one between brackets stands between lists
    lists = pieces.select("db", F.explode(F.split(text, r"(?<=\])\s*\n\s*(?=\[)")).alias("list"))
    ids = lists.select("db", F.explode(F.from_json("list", "array<string>")).alias("id"))
    return ids.where("id <> ''")


def records_to_table(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """Records as JSON lines; columns are the union of the keys."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(_paths(path))


def read_xml_batches(
    spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None
) -> DataFrame:
    """One row per ``row_tag`` element; attributes become ``_name`` columns."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_id_response_log(spark: SparkSession, path: str) -> DataFrame:
    """``(page, id)`` from indented JSON responses separated by blank lines.

    The blank line serves as record separator, so a long log is split over
    tasks. Pages count from 0 in file order.
    """
    documents = (
        spark.read.option("lineSep", "\n\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
        .where(F.trim("value") != "")
    )
    pages = with_row_number(documents, ["file", "block", "place"], name="page")
    answer = F.from_json("value", "Count string, IdList array<string>")
    return pages.select((F.col("page") - 1).alias("page"), F.explode(answer["IdList"]).alias("id"))
