"""Operators on column names and nested columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.values import quoted
from tablewright.operators.cleaning import keep_columns


def split_xml_columns(df: DataFrame, suffix: str = "Xml") -> tuple[list[str], list[str]]:
    """Names of the plain columns and of the columns holding XML."""
    xml = [name for name in df.columns if name.endswith(suffix)]
    return [name for name in df.columns if not name.endswith(suffix)], xml


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by their exact names, case included; names that are not there are ignored."""
    names = set(names)
    return keep_columns(df, [name for name in df.columns if name not in names])


def select_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return keep_columns(df, [a, b])


def distinct_names(names: Iterable[str], fold: bool = False) -> list[str]:
    """Append ``_2``, ``_3`` … to repeated names, in order; ``fold`` ignores case."""
    names = list(names)

    def form(name: str) -> str:
        return name.lower() if fold else name

    wanted = {form(name) for name in names}
    taken: set[str] = set()
    result = []
    for name in names:
        fresh, n = name, 1
        while form(fresh) in taken or (n > 1 and form(fresh) in wanted):
            n += 1
            fresh = f"{name}_{n}"
        taken.add(form(fresh))
        result.append(fresh)
    return result


def ignores_case(df: DataFrame) -> bool:
    """Whether names that differ by case alone are one name to the session."""
    return df.sparkSession.conf.get("spark.sql.caseSensitive") != "true"


def short_names(names: Sequence[str], threshold: float = 0.20) -> list[str]:
    """Names without leading underscores and without a leading part common to many."""
    bare = [name.lstrip("_") for name in names]
    uses = Counter(part for name in bare for part in name.split("_"))
    limit = threshold * len(bare)

    def shorten(name: str) -> str:
        head, mark, rest = name.partition("_")
        return rest if mark and uses[head] > limit else name

    return distinct_names(shorten(name) for name in bare)


def strip_common_name_prefixes(df: DataFrame, threshold: float = 0.20) -> DataFrame:
    return df.toDF(*short_names(df.columns, threshold))


def column_mapping(
    spark: SparkSession,
    original: Sequence[str],
    renamed: Sequence[str],
    removed: Iterable[str] = (),
) -> DataFrame:
    """Old name, new name (null if removed) and whether the column is gone."""
    rows = [(old, new, False) for old, new in zip(original, renamed, strict=True)]
    rows += [(name, None, True) for name in removed]
    return spark.createDataFrame(rows, "original string, renamed string, removed boolean")


def replaced_names(original: Sequence[str], renamed: Sequence[str]) -> list[str]:
    """Original names that no longer occur."""
    kept = set(renamed)
    return [name for name in original if name not in kept]


def flatten_nested(df: DataFrame, sep: str = "_", arrays: str = "json") -> DataFrame:
    """Turn nested columns into plain ones, level by level.

    Struct fields become ``parent<sep>child`` columns and maps become JSON.
    ``arrays`` says what becomes of lists: ``explode`` (sibling lists advance
    together, one row per position), ``first`` (the first element) or ``json``.
    Names that clash get a number, also those that differ by case alone unless the session tells them apart.
    """
    if arrays not in ("explode", "first", "json"):
        raise ValueError(f"unknown array handling {arrays!r}")
    while True:
        fields = df.schema.fields
        lists = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
        if not any(isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType)) for f in fields):
            return df
        if lists and arrays == "explode":
            df = _explode_together(df, lists)
            continue
        # by place: names may be one to the session
        placed, cells = df.toDF(*[f"c{i}" for i in range(len(fields))]), []
        for i, f in enumerate(fields):
            value = F.col(f"c{i}")
            if isinstance(f.dataType, T.StructType):
                parts = [T.StructField(f"p{k}", part.dataType) for k, part in enumerate(f.dataType)]
                value = value.cast(T.StructType(parts)) if parts else value
                cells += [
                    (f"{f.name}{sep}{child}", value.getField(f"p{k}"))
                    for k, child in enumerate(f.dataType.fieldNames())
                ]
            elif isinstance(f.dataType, T.ArrayType) and arrays == "first":
                cells.append((f.name, F.get(value, 0)))
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                cells.append((f.name, F.to_json(value)))
            else:
                cells.append((f.name, value))
        names = distinct_names((name for name, _ in cells), fold=ignores_case(df))
        df = placed.select(*[value.alias(name) for name, (_, value) in zip(names, cells, strict=True)])


def _explode_together(df: DataFrame, lists: Sequence[str]) -> DataFrame:
    zipped = F.arrays_zip(
        *[
            F.coalesce(F.col(quoted(name)), F.array().cast(df.schema[name].dataType)).alias(f"v{i}")
            for i, name in enumerate(lists)
        ]
    )
    place = {name: i for i, name in enumerate(lists)}
    plain = [name for name in df.columns if name not in place]
    exploded = df.select(*[quoted(n) for n in plain], F.explode_outer(zipped).alias("__item"))
    return exploded.select(
        *[
            F.col("__item").getField(f"v{place[n]}").alias(n)
            if n in place
            else F.col(quoted(n))
            for n in df.columns
        ]
    )
