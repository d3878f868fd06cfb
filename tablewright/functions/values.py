"""Comparable values: a value is its type family plus a canonical form.

Numbers of any width compare by value (1 equals 1.0), but a number never
equals the string that spells it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER, STRING, BOOLEAN, TIME, NESTED, OTHER = range(6)

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_LONG_LIMIT = 9.2e18


def family_of(dtype: T.DataType) -> int:
    if isinstance(dtype, (*_INTEGERS, *_FLOATS, T.DecimalType)):
        return NUMBER
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return STRING
    if isinstance(dtype, T.BooleanType):
        return BOOLEAN
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return TIME
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return NESTED
    return OTHER


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_value(name: str, dtype: T.DataType) -> Column:
    """The column with a float NaN read as null."""
    value = F.col(quoted(name))
    if isinstance(dtype, _FLOATS):
        return F.when(~F.isnan(value), value)
    return value


def _as_double(text: Column) -> Column:
    """The double that a decimal's text stands for, if it stands for that decimal in return; else null.

    Up to 15 digits always come back; of longer texts those that are the
    shortest text of their double do.
    """
    digits = F.length(F.regexp_replace(F.regexp_replace(text, "[-.]", ""), "^0+|0+$", ""))
    real = text.try_cast("double")
    exact = "decimal(38,20)"
    back = real.cast("string").try_cast(exact) == text.try_cast(exact)
    short = F.length(F.regexp_extract(text, r"\.(.*)", 1)) <= 20
    return F.when((digits <= 15) | (short & back), real)


def canonical_text(name: str, dtype: T.DataType) -> Column:
    """Text that is equal exactly when two values of one family are equal."""
    value = clean_value(name, dtype)
    if isinstance(dtype, _FLOATS):
        wide = value.cast("double")
        whole = (F.abs(wide) < _LONG_LIMIT) & (wide == F.floor(wide))
        return F.when(whole, wide.try_cast("bigint").cast("string")).otherwise(
            wide.cast("string")
        )
    if isinstance(dtype, T.DecimalType):
        text = value.cast("string")
        text = F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
        real = _as_double(text)
        whole = real.isNull() | ((F.abs(real) < _LONG_LIMIT) & (real == F.floor(real)))
        return F.when(whole, text).otherwise(real.cast("string"))
    if isinstance(dtype, T.DateType):
        return value.cast("timestamp").cast("string")
    if family_of(dtype) == NESTED:
        return F.to_json(value)
    return value.cast("string")


def comparable(dtypes: list[T.DataType]) -> Callable[[str, T.DataType], Column]:
    """A form in which columns of one family are equal when their values are, as narrow as their types allow."""
    if all(isinstance(t, (*_INTEGERS, T.BooleanType)) for t in dtypes):
        return lambda name, dtype: F.col(quoted(name)).cast("bigint")
    if all(isinstance(t, (*_FLOATS, T.ByteType, T.ShortType, T.IntegerType)) for t in dtypes):
        # a double holds every int
        return lambda name, dtype: clean_value(name, dtype).cast("double")
    if all(family_of(t) == TIME for t in dtypes):
        return lambda name, dtype: F.unix_micros(F.col(quoted(name)).cast("timestamp"))
    return canonical_text


KEY = ("num", "dbl", "txt")


def value_key(name: str, dtype: T.DataType) -> tuple[Column, Column, Column]:
    """``(num, dbl, txt)``, of which the one that fits the type holds the value.

    Values of one column are equal when the triples are; across columns
    ``canonical_key`` is needed as well. No number or time is turned into text.
    """
    value = F.col(quoted(name))
    none = {"num": "bigint", "dbl": "double", "txt": "string"}
    family = family_of(dtype)
    if isinstance(dtype, _INTEGERS) or family == BOOLEAN:
        part = {"num": value.cast("bigint")}
    elif isinstance(dtype, _FLOATS):
        part = {"dbl": value.cast("double")}
    elif family == TIME:
        part = {"num": F.unix_micros(value.cast("timestamp"))}
    else:
        part = {"txt": canonical_text(name, dtype)}
    return tuple(part.get(k, F.lit(None).cast(none[k])) for k in KEY)


def canonical_key(df: DataFrame, decimals: bool = False) -> DataFrame:
    """Bring stacked keys of different number types into one form.

    Doubles without a fraction move to ``num``. In tables whose ``family``
    says that they are numbers, texts of decimals go where their value is at
    home: whole ones to ``num``, those that a double holds as well to ``dbl``. Only decimals that
    are no value of another type stay texts.
    """
    dbl, num, txt = F.col("dbl"), F.col("num"), F.col("txt")
    if decimals:
        number = (F.col("family") == NUMBER) & txt.isNotNull()
        whole_text = F.when(number & ~txt.contains("."), txt.try_cast("bigint"))
        real = F.when(number & whole_text.isNull(), _as_double(txt))
        df = df.withColumns(
            {
                "num": F.coalesce(num, whole_text),
                "dbl": F.coalesce(dbl, real),
                "txt": F.when(whole_text.isNull() & real.isNull(), txt),
            }
        )
    whole = (F.abs(dbl) < _LONG_LIMIT) & (dbl == F.floor(dbl))
    whole = F.coalesce(whole, F.lit(False))
    return df.withColumns(
        {"num": F.coalesce(num, F.when(whole, dbl.try_cast("bigint"))), "dbl": F.when(~whole, dbl)}
    )


def decimal_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Move stacked decimals, of which a row has one at most, to the key where their value is at home.

    That is where ``canonical_key`` puts their ``canonical_text``. Each step is a
    projection of its own: in one they would outgrow the code that Spark compiles.
    """
    texts = [F.col(quoted(n)).cast("string") for n in names]
    df = df.withColumn("__text", F.coalesce(*texts))
    trimmed = F.rtrim(F.rtrim(F.col("__text"), F.lit("0")), F.lit("."))
    df = df.withColumn("__text", F.when(F.contains("__text", F.lit(".")), trimmed).otherwise(F.col("__text")))
    text, real, whole = F.col("__text"), F.col("__real"), F.col("__whole")
    df = df.withColumn("__real", _as_double(text))
    small = F.coalesce(F.abs(real) < _LONG_LIMIT, F.lit(True))
    df = df.withColumn("__whole", F.when(~text.contains(".") & small, text.try_cast("bigint")))
    return df.withColumns(
        {
            "num": F.coalesce("num", whole),
            "dbl": F.coalesce("dbl", F.when(whole.isNull(), real)),
            "txt": F.coalesce("txt", F.when(whole.isNull() & real.isNull(), text)),
        }
    ).drop("__text", "__real", "__whole", *names)


def has_key() -> Column:
    return F.col("num").isNotNull() | F.col("dbl").isNotNull() | F.col("txt").isNotNull()


def sortable(name: str, dtype: T.DataType) -> Column:
    """A fixed-width stand-in whose smallest and largest tell whether values differ.

    Text and nested values are hashed, see ``is_exactly_sortable``.
    """
    value = clean_value(name, dtype)
    if is_exactly_sortable(dtype):
        return value
    return own_hash(name, dtype)


def is_exactly_sortable(dtype: T.DataType) -> bool:
    return family_of(dtype) in (NUMBER, BOOLEAN, TIME) and not isinstance(dtype, T.DecimalType)


def value_hash(name: str, dtype: T.DataType) -> Column:
    """64-bit hash, equal for equal values of a family; null stays null.

    Used to rule things out only; equal hashes are always verified.
    """
    value = clean_value(name, dtype)
    family = family_of(dtype)
    if family == NUMBER:
        hashed = F.xxhash64(F.lit(family), value.cast("double"))
    elif isinstance(dtype, T.DateType):
        hashed = F.xxhash64(F.lit(family), value.cast("timestamp"))
    elif family == NESTED:
        hashed = F.xxhash64(F.lit(family), F.to_json(value))
    else:
        hashed = F.xxhash64(F.lit(family), value)
    return F.when(value.isNotNull(), hashed)


def own_hash(name: str, dtype: T.DataType) -> Column:
    """64-bit hash that tells all values of one column apart, wide integers included."""
    value = clean_value(name, dtype)
    if family_of(dtype) == NESTED:
        value = F.to_json(value)
    return F.when(value.isNotNull(), F.xxhash64(value))


def same_value(left: Column, right: Column, null_safe: bool = False) -> Column:
    """Equality that is never null."""
    if null_safe:
        return left.eqNullSafe(right)
    return F.coalesce(left == right, F.lit(False))
