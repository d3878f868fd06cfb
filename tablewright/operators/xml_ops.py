"""Flattening XML fragments held in string columns.

A fragment is parsed once, in the JVM, into a variant. Reading the keys out of
the variant needs no schema, so rows may all have different elements.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.fragments import balance_fragment
from tablewright.functions.text import WHITESPACE, strip_whitespace
from tablewright.functions.values import quoted
from tablewright.operators.schema_ops import distinct_names, flatten_nested, ignores_case, split_xml_columns
from tablewright.session import materialize, spread

# A private-use character put in front of every text and attribute value. The
# parser would otherwise turn 012 into 12, and would drop the blank text nodes
# that tell an element with one child from one with several.
_MARK = "\ue000"
_OPTIONS = {"mode": "PERMISSIVE", "attributePrefix": "@", "valueTag": "#", "ignoreNamespace": "false"}
_SCHEMA = "r VARIANT, _corrupt_record STRING"

# JSON of one parsed element that has attributes or children: a chain of objects,
# each with one child and any attributes, around a string.
_JSON_TEXT = r'"(?:[^"\\]|\\.)*+"'
_JSON_ATTRIBUTES = rf'(?:"@(?:[^"\\]|\\.)*+":{_JSON_TEXT},)*+'
_CHAIN = (
    rf'^(?:\{{{_JSON_ATTRIBUTES}"(?![@#])(?:[^"\\]|\\.)*+":)*+'
    rf'(?:\{{"#":)?({_JSON_TEXT})(?:,"@(?:[^"\\]|\\.)*+":{_JSON_TEXT})*+\}}*$'
)

# An element of the common kind: three levels at most, plain names, double quotes, no entities,
# comments or sections. What it matches is well-formed and reads as it stands.
_NAME = r"(?!(?i:xml))[A-Za-z_][A-Za-z0-9_.-]*+"


def _common_element(levels: int, group: int = 1) -> str:
    attributes = rf'(?:\s++({_NAME})="[^"<>&\t\n]*+"(?![^>]*\s(?i:\{group + 1})=))*+'
    content = "[^<>&]*+" if levels == 1 else f"(?:[^<>&]++|{_common_element(levels - 1, group + 2)})*+"
    return rf"<({_NAME}){attributes}\s*+(?:/>|>{content}</\{group}\s*+>)"


_ELEMENT = _common_element(3)
# Characters that the parser rejects or changes, and values that end in an equals sign, which ``_marked`` cuts.
_UNCOMMON = r'[\x00-\x08\x0b-\x1f\ue000\ufffe\uffff]|=\s*"[\s/>]'
#: Longer fragments are left to the parser: a regular expression takes some stack for each repeat.
_MOST = 2000
# A common element that holds one text, directly or down a chain of single children.
_ONE_TEXT = r"^(?:<(?!/)[^<>]+(?<!/)>)+([^<>]*)(?:</[^<>]+>)+$"

# JSON of an element of a skeleton that has attributes but no children.
_LEAF = r'^\{(?:"[@#][^"]*":(?:"[^"]*"|null),?)*\}$'


def _marked(fragment: Column) -> Column:
    text = F.regexp_replace(fragment, r"""(>(?=[^<])|=\s*["']|<!\[CDATA\[)""", "$1" + _MARK)
    return F.concat(F.lit("<q><r>"), text, F.lit("</r></q>"))


def _parsed(fragment: Column) -> Column:
    return F.from_xml(_marked(fragment), _SCHEMA, _OPTIONS)


def is_malformed(fragment: Column) -> Column:
    """Whether the parser rejects a fragment; it builds nothing of what it reads."""
    return F.coalesce(_checked(fragment)["_corrupt_record"].isNotNull(), F.lit(False))


def _plain(text: Column) -> Column:
    return strip_whitespace(F.translate(text, _MARK, ""))


def _as_map(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "map<string,variant>")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time."""
    return F.get(F.transform(F.array(value), use), 0)


def _chain_text(json: Column) -> Column:
    """The one text of an element with attributes or children, else null."""

    def unquoted(text: Column) -> Column:
        bare = F.substring(text, F.lit(2), F.length(text) - 2)
        escaped = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")
        return F.when(text == "", None).when(F.contains(text, F.lit("\\")), escaped).otherwise(bare)

    return _once(F.regexp_extract(json, _CHAIN, 1), unquoted)


def _element_pairs(tag: Column, element: Column) -> Column:
    """``[(key, value)]`` of one element: its text, then its attributes."""

    def text_pair(text: Column) -> Column:
        own = F.array(F.struct(tag.alias("key"), _plain(text).alias("value")))
        return F.filter(own, lambda p: p["value"] != "")

    def attribute(entry: Column) -> Column:
        value = _plain(F.try_variant_get(entry["value"], "$", "string"))
        return F.struct(F.concat(tag, F.lower(entry["key"])).alias("key"), value.alias("value"))

    def of_object(json: Column) -> Column:
        entries = F.filter(F.map_entries(_as_map(element)), lambda e: e["key"].startswith("@"))
        return F.concat(text_pair(_chain_text(json)), F.transform(entries, attribute))

    # plain text always starts with the mark, anything else reads as JSON
    return _once(
        F.try_variant_get(element, "$", "string"),
        lambda read: F.when(read.startswith(_MARK), text_pair(read))
        .when(read.startswith("{"), of_object(read))
        .otherwise(F.array().cast("array<struct<key:string,value:string>>")),
    )


def fragment_pairs(fragment: Column) -> Column:
    """``array<struct<key, value>>`` of a fragment's top-level elements.

    An element gives its text under its lower-cased name, if all it holds is
    one text (directly or down a chain of single children), and each attribute
    as ``name@attribute``. Repeats follow document order. Malformed fragments
    give null.

    Fragments made up of common elements are read by regular expressions,
    which takes a fraction of the time; the parser reads all others, and those with names that differ by case alone.
    """
    may_be = (F.length(fragment) <= _MOST) & ~fragment.rlike(_UNCOMMON)
    elements = F.when(may_be, F.regexp_extract_all(fragment, F.lit(_ELEMENT), F.lit(0)))

    def read(found: Column) -> Column:
        tags = F.transform(found, lambda e: F.regexp_extract(e, r"^<([^\s/>]+)", 1))
        # of names that differ by case alone the parser doesn't keep the order
        spellings = _once(tags, lambda t: F.size(F.array_distinct(t)) - F.size(F.array_distinct(F.transform(t, F.lower))))
        common = (F.array_join(found, "") == fragment) & (fragment != "") & ((F.size(found) < 2) | (spellings == 0))
        return F.when(common, F.flatten(F.transform(found, _common_pairs))).otherwise(_pairs(_parsed(fragment)))

    return _once(elements, read)


def _common_pairs(element: Column) -> Column:
    """``_element_pairs`` of a common element, from its text."""

    def of_tag(tag: Column) -> Column:
        text = strip_whitespace(F.regexp_extract(element, _ONE_TEXT, 1))
        none = F.array().cast("array<struct<key:string,value:string>>")
        own = F.when(text != "", F.array(F.struct(tag.alias("key"), text.alias("value")))).otherwise(none)
        head = F.regexp_extract(element, "^[^>]*", 0)
        written = F.regexp_extract_all(head, F.lit(r'\s([^\s=]+="[^"]*")'), F.lit(1))

        def attribute(pair: Column) -> Column:
            name, value = F.substring_index(pair, "=", 1), F.regexp_extract(pair, r'="([^"]*)', 1)
            return F.struct(F.concat(tag, F.lit("@"), F.lower(name)).alias("key"), strip_whitespace(value).alias("value"))

        return F.when(F.contains(head, F.lit("=")), F.concat(own, F.transform(written, attribute))).otherwise(own)

    return _once(F.lower(F.regexp_extract(element, r"^<([^\s/>]+)", 1)), of_tag)


def _pairs(parsed: Column) -> Column:
    entries = F.filter(
        F.map_entries(_as_map(parsed["r"])),
        lambda e: ~(e["key"].startswith("@") | e["key"].startswith("#")),
    )

    def of_entry(entry: Column) -> Column:
        elements = F.coalesce(
            F.try_variant_get(entry["value"], "$", "array<variant>"), F.array(entry["value"])
        )
        return F.flatten(
            F.transform(elements, lambda element: _element_pairs(F.lower(entry["key"]), element))
        )

    return F.flatten(F.transform(entries, of_entry))


def first_value(pairs: Column, key: str) -> Column:
    """The first value of one key among ``fragment_pairs``."""
    return F.get(F.filter(pairs, lambda p: p["key"] == key), 0)["value"]


def xml_fragment_to_long(df: DataFrame, id: str, column: str, repair: bool = True) -> DataFrame:
    """``(id, key, pos, value)``; ``pos`` counts the repeats of a key from 0.

    Malformed fragments are repaired unless ``repair`` is off; then they give nothing.
    The fragments are written to a stage first, dealt to all cores.
    """
    # spread by a stage, since the filters that split the rows would be pushed below a shuffle
    rows = materialize(spread(df.select(quoted(id), quoted(column))), "fragments")
    if repair:
        rows = _repaired(rows, [column])
    rows = rows.withColumn("__pairs", fragment_pairs(F.col(quoted(column))))
    keys = F.array_distinct(F.transform("__pairs", lambda p: p["key"]))

    def of_key(key: Column) -> Column:
        return F.transform(
            F.filter("__pairs", lambda p: p["key"] == key),
            lambda p, i: F.struct(key.alias("key"), i.alias("pos"), p["value"].alias("value")),
        )

    return (
        rows.select(quoted(id), F.explode(F.flatten(F.transform(keys, of_key))).alias("__p"))
        .select(quoted(id), "__p.key", "__p.pos", "__p.value")
    )


def flatten_xml_columns(
    df: DataFrame,
    suffix: str = "Xml",
    mode: str = "first",
    repair: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Plain columns plus one column per XML key.

    A later XML column overrides an earlier one and a plain column of the same
    name, cell by cell. ``first`` keeps a key's first value, ``all`` all of
    them as an array (plain columns it overrides then become arrays too).
    Malformed fragments are repaired unless ``repair`` is off.

    One scan finds the shapes of the fragments, and writes down the rows with
    malformed ones, which are repaired apart. The table itself is then a plain
    projection that parses every fragment once and leaves those rows out. Give ``partitions`` to spread rows first when they come
    from fewer files than there are cores (files with line breaks in cells
    cannot be split).
    """
    if mode not in ("first", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    plain, xml = split_xml_columns(df, suffix)
    if not xml:
        return df
    if partitions is not None:
        df = df.repartition(partitions)
    shapes, broken, bad_rows = _survey(df, xml, stage=repair)
    if bad_rows is not None:
        for shape, more in zip(shapes, find_shapes(bad_rows, xml)[0], strict=True):
            shape.add(more)

    def value_of(i: int, key: str) -> Column:
        values = shapes[i].values(F.col(f"__p{i}"), key)
        if mode == "all":
            return F.when(F.size(values) > 0, values)
        return F.get(values, 0)

    found: dict[str, list[int]] = {}
    for i, shape in enumerate(shapes):
        for key in sorted(shape.keys):
            found.setdefault(key, []).append(i)
    cells = []
    for name in plain:
        value = F.col(quoted(name))
        if name in found:
            text = value.cast("string")
            base = F.when(value.isNotNull(), F.array(text)) if mode == "all" else text
            value = F.coalesce(*[value_of(i, name) for i in reversed(found[name])], base)
        cells.append((name, value))
    for key, sources in found.items():
        if key not in plain:
            cells.append((key, F.coalesce(*[value_of(i, key) for i in reversed(sources)])))
    names = distinct_names((name for name, _ in cells), fold=ignores_case(df))
    out = [v.alias(n) for n, (_, v) in zip(names, cells, strict=True)]
    if bad_rows is None:
        return _parsed_rows(df, plain, xml, shapes).select(*out)
    # what the one parse finds malformed gives no row here; a filter would be parsed for by itself
    read = _parsed_rows(df, plain, xml, shapes, [xml.index(c) for c in broken])
    row = F.struct(*out)
    fine = read.select(F.explode(F.when(F.col("__bad"), F.slice(F.array(row), 1, 0)).otherwise(F.array(row))).alias("__row"))
    fine = fine.select(*[F.col("__row").getField(n).alias(n) for n in names])
    return fine.unionAll(_parsed_rows(bad_rows, plain, xml, shapes).select(*out))


def _parsed_rows(
    df: DataFrame, plain: list[str], xml: list[str], shapes: list[Shape], watch: list[int] | None = None
) -> DataFrame:
    """The plain columns and ``__p0``, ``__p1`` …: what the fragments hold. ``__bad``: whether one of ``watch`` is malformed."""
    cells = []
    for i, (c, shape) in enumerate(zip(xml, shapes, strict=True)):
        fragment = F.col(quoted(c))
        cells.append((shape.parse_checked if watch is not None and i in watch else shape.parse)(fragment).alias(f"__p{i}"))
    read = df.select(*[quoted(c) for c in plain], *cells)
    if watch is None:
        return read
    bad = reduce(Column.__or__, [F.coalesce(F.col(f"__p{i}._corrupt_record").isNotNull(), F.lit(False)) for i in watch])
    values = [F.col(f"__p{i}.r").alias(f"__p{i}") if i in watch else F.col(f"__p{i}") for i in range(len(xml))]
    return read.select(*[quoted(c) for c in plain], *values, bad.alias("__bad"))


class Shape:
    """What the top-level elements of one XML column look like, over all rows.

    ``parse`` turns a fragment into a struct with exactly these elements,
    which is much cheaper than a variant. Where the elements need more (text
    cut up by comments, chains of more than one child, names that differ only
    by case) it keeps to the general way, ``fragment_pairs``.
    """

    def __init__(self) -> None:
        self.keys: set[str] = set()
        self.parts: dict[str, dict[str, set[str]]] = {}
        self.general = False

    def note(self, tag: str, kind: str, name: str | None) -> None:
        if kind == "general":
            self.general = True
            return
        part = self.parts.setdefault(tag, {"text": set(), "attr": set(), "child": set()})
        part[kind].add(name or "")
        if kind == "text":
            self.keys.add(tag.lower())
        elif kind == "attr":
            self.keys.add(f"{tag}@{name}".lower())

    def add(self, other: Shape) -> None:
        self.keys |= other.keys
        self.general |= other.general
        for tag, part in other.parts.items():
            mine = self.parts.setdefault(tag, {"text": set(), "attr": set(), "child": set()})
            for kind, names in part.items():
                mine[kind] |= names

    def _is_simple(self) -> bool:
        spellings = [list(self.parts)]
        for part in self.parts.values():
            spellings += [list(part["attr"]), list(part["child"])]
        return not self.general and all(len({n.lower() for n in names}) == len(names) for names in spellings)

    def _tags(self) -> list[str]:
        return sorted(t for t, part in self.parts.items() if part["text"] or part["attr"])

    def _schema(self) -> T.StructType:
        tags = []
        for tag in self._tags():
            part = self.parts[tag]
            fields = [T.StructField("#", T.StringType())]
            fields += [T.StructField(f"@{a}", T.StringType()) for a in sorted(part["attr"])]
            if part["text"]:
                fields += [T.StructField(c, T.ArrayType(T.StringType())) for c in sorted(part["child"])]
            tags.append(T.StructField(tag, T.ArrayType(T.StructType(fields))))
        return T.StructType([T.StructField("r", T.StructType(tags))] if tags else [])

    def parse(self, fragment: Column) -> Column:
        if not self._is_simple():
            return fragment_pairs(fragment)
        schema = self._schema()
        return F.from_xml(_marked(fragment), schema, _OPTIONS)["r"] if schema.fields else F.lit(None).cast("string")

    def parse_checked(self, fragment: Column) -> Column:
        """``r``, as ``parse`` has it, and ``_corrupt_record``, set if the fragment is malformed; from one parse."""
        if not self._is_simple():
            return _once(_parsed(fragment), lambda p: F.struct(_pairs(p).alias("r"), p["_corrupt_record"].alias("_corrupt_record")))
        schema = self._schema()
        known = F.from_xml(_marked(fragment), T.StructType([*schema, T.StructField("_corrupt_record", T.StringType())]), _OPTIONS)
        if schema.fields:
            return known
        return F.struct(F.lit(None).cast("string").alias("r"), known["_corrupt_record"].alias("_corrupt_record"))

    def values(self, parsed: Column, key: str) -> Column:
        """All values of a key, in document order."""
        if not self._is_simple():
            return F.transform(F.filter(parsed, lambda p: p["key"] == key), lambda p: p["value"])
        base, mark, attribute = key.partition("@")
        tag = next(
            t
            for t in self._tags()
            if t.lower() == base
            and (not mark or attribute in {a.lower() for a in self.parts[t]["attr"]})
        )
        part = self.parts[tag]
        if mark:
            name = next(a for a in part["attr"] if a.lower() == attribute)
            found = F.transform(parsed[tag], lambda e: _plain(e[f"@{name}"]))
            return F.filter(found, lambda v: v.isNotNull())
        found = F.transform(parsed[tag], lambda e: _plain(self._text(e, sorted(part["child"]))))
        return F.filter(found, lambda v: v.isNotNull() & (v != ""))

    def _text(self, element: Column, children: list[str]) -> Column:
        own = element["#"]
        if not children:
            return own
        count = sum((F.coalesce(F.array_size(element[c]), F.lit(0)) for c in children), F.lit(0))
        only = F.coalesce(*[F.get(element[c], 0) for c in children])
        return F.when(count == 0, own).when((count == 1) & own.isNull(), only)


def _skeleton(fragment: Column) -> Column:
    """The fragment with every text and attribute value reduced to a letter.

    Blank text becomes the mark instead. More than two equal elements in a row
    become two. Fragments with comments or CDATA are left as they are.
    """
    # one pass empties quoted values and puts "" behind each text, by which the next ones find the texts;
    # a text is matched as a whole, so that quotes and ends of tags within it count for nothing
    bare = F.regexp_replace(F.concat(F.lit(">"), fragment), r"""(?=[>"'])(?:(>[^<]+)|"[^"]*"|'[^']*')""", '$1""')
    bare = F.regexp_replace(bare, rf'>[{WHITESPACE}]+""(?=<|\z)', ">" + _MARK)
    bare = F.regexp_replace(bare, r'>[^<]+""(?=<|\z)', ">x")
    short = F.regexp_replace(bare, r"((<([^\s<>/]++)[^<>]*+>(?:(?<=/>)|[^<>]*+</\3>))\2)\2++", "$1")
    short = F.substring(short, 2, 2**31 - 1)
    return F.when(fragment.contains("<!"), _marked_only(fragment)).otherwise(short)


def _marked_only(fragment: Column) -> Column:
    # keeps numbers from being read as such; the letter stands for any text
    return F.regexp_replace(fragment, r"""(>(?=[^<])|=\s*["']|<!\[CDATA\[)""", "$1x")


def find_shapes(df: DataFrame, xml: list[str]) -> tuple[list[Shape], list[str]]:
    """The shape of each XML column, and the columns with malformed cells.

    Rows are reduced to distinct skeletons before anything is looked at in
    detail; those combine before the shuffle. What reaches the driver grows
    with the number of element names, not with the rows.
    """
    return _survey(df, xml, stage=False)[:2]


def _survey(df: DataFrame, xml: list[str], stage: bool) -> tuple[list[Shape], list[str], DataFrame | None]:
    """``find_shapes``, and with ``stage`` the rows with malformed fragments, repaired; None if there are none.

    One scan that parses each fragment once: it gives the distinct skeletons, and
    with them the rows that need repair, which are written down.
    """
    fragments = {c: f"__f{i}" for i, c in enumerate(xml)}
    checks = [is_malformed(F.col(quoted(c))).alias(f"__b{i}") for i, c in enumerate(xml)]
    # a row goes along as a whole if a fragment is malformed; grouping can't take maps
    wanted, stage = stage, stage and not any(_has_map(f.dataType) for f in df.schema)
    kept = [F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("__row")] if stage else []
    checked = df.select(*[F.col(quoted(c)).alias(f) for c, f in fragments.items()], *checks, *kept)
    none = F.lit(None).cast("string")
    row_type = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)])
    no_row = F.lit(None).cast(row_type if stage else "int")
    cells = [
        F.when(
            F.col(fragments[c]).isNotNull(),
            F.struct(
                F.lit(i).alias("source"),
                F.col(f"__b{i}").alias("bad"),
                F.when(~F.col(f"__b{i}"), _skeleton(F.col(fragments[c]))).alias("s"),
                no_row.alias("row"),
            ),
        )
        for i, c in enumerate(xml)
    ]
    if stage:
        bad = reduce(Column.__or__, [F.col(f"__b{i}") for i in range(len(xml))])
        cells.append(F.when(bad, F.struct(F.lit(-1).alias("source"), bad.alias("bad"), none.alias("s"), F.col("__row").alias("row"))))
    rows = checked.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.*")
    found = rows.groupBy("source", "bad", "s", "row").agg(F.count(F.lit(1)).alias("n"))
    if stage:
        found = materialize(found, "fragment-shapes")
    skeletons = found.where("source >= 0").select("source", "bad", "s")
    shapes, broken = _shapes_of(df, xml, skeletons)
    if not wanted or not broken:
        return shapes, broken, None
    if not stage:
        damaged = reduce(Column.__or__, [is_malformed(F.col(quoted(c))) for c in broken])
        return shapes, broken, _repaired(df.where(damaged), broken)
    again = found.where("source = -1").select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("__copy"))
    bad_rows = again.select(*[F.col("row").getField(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
    fixed = {c: repaired_value(F.col(quoted(c))) for c in broken}
    bad_rows = bad_rows.select(*[fixed[c].alias(c) if c in fixed else F.col(quoted(c)) for c in df.columns])
    return shapes, broken, materialize(bad_rows, "repaired-rows")


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _shapes_of(df: DataFrame, xml: list[str], skeletons: DataFrame) -> tuple[list[Shape], list[str]]:
    parsed = skeletons.select(
        "source", "bad", F.from_xml(F.concat(F.lit("<q><r>"), "s", F.lit("</r></q>")), _SCHEMA, _OPTIONS).alias("p")
    )
    none = F.array().cast("array<struct<tag:string,kind:string,name:string>>")
    notes = (
        F.when(F.col("bad"), F.array(_note(None, "bad")))
        .when(F.col("p._corrupt_record").isNotNull(), F.array(_note(None, "general")))
        .otherwise(F.coalesce(_notes(_as_map(F.col("p.r"))), none))
    )
    distinct = parsed.select("source", F.explode(notes).alias("n")).select("source", "n.*").distinct()
    shapes, broken = [Shape() for _ in xml], set()
    for r in distinct.collect():
        if r["kind"] == "bad":
            broken.add(r["source"])
        else:
            shapes[r["source"]].note(r["tag"], r["kind"], r["name"])
    for i, shape in enumerate(shapes):
        if shape.general:
            shape.keys = _keys_in_general(df, xml[i])
    return shapes, [xml[i] for i in sorted(broken)]


def _checked(fragment: Column) -> Column:
    wrapped = F.concat(F.lit("<q><r>"), fragment, F.lit("</r></q>"))
    return F.from_xml(wrapped, "_corrupt_record STRING", _OPTIONS)


def _keys_in_general(df: DataFrame, column: str) -> set[str]:
    pairs = df.select(F.explode(fragment_pairs(F.col(quoted(column)))).alias("p"))
    return {r["key"] for r in pairs.select("p.key").distinct().collect()}


def _note(tag: Column | None, kind: str, name: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        (none if tag is None else tag).alias("tag"),
        F.lit(kind).alias("kind"),
        (none if name is None else name).alias("name"),
    )


def _notes(elements: Column) -> Column:
    """Notes on every top-level element of a parsed skeleton."""
    entries = F.filter(
        F.map_entries(elements), lambda e: ~(e["key"].startswith("@") | e["key"].startswith("#"))
    )

    def of_entry(entry: Column) -> Column:
        repeats = F.coalesce(
            F.try_variant_get(entry["value"], "$", "array<variant>"), F.array(entry["value"])
        )
        return F.flatten(F.transform(repeats, lambda e: _element_notes(entry["key"], e)))

    return F.flatten(F.transform(entries, of_entry))


def _element_notes(tag: Column, element: Column) -> Column:
    none = F.array().cast("array<struct<tag:string,kind:string,name:string>>")
    read = F.try_variant_get(element, "$", "string")

    def of_object(entries: Column) -> Column:
        attributes = F.filter(entries, lambda e: e["key"].startswith("@"))
        children = F.filter(
            entries, lambda e: ~(e["key"].startswith("@") | e["key"].startswith("#"))
        )
        own = F.get(F.filter(entries, lambda e: e["key"] == "#"), 0)["value"]
        own_text = F.try_variant_get(own, "$", "string")
        child = F.try_variant_get(F.get(children, 0)["value"], "$", "string")
        single = (F.size(children) == 1) & own.isNull()
        text = (
            F.when((F.size(children) == 0) & own_text.contains("x"), F.array(_note(tag, "text")))
            .when(single & child.rlike(_LEAF), F.when(child.contains('"#":"x"'), F.array(_note(tag, "text"))).otherwise(none))
            .when(single & child.startswith("{"), F.array(_note(tag, "general")))
            .when(single & child.startswith("["), none)
            .when(single & child.contains("x"), F.array(_note(tag, "text")))
            .otherwise(none)
        )
        cut = F.when((F.size(children) == 0) & own_text.startswith("["), F.array(_note(tag, "general"))).otherwise(none)
        return F.concat(
            text,
            cut,
            F.transform(attributes, lambda e: _note(tag, "attr", F.substring(e["key"], 2, 2**31 - 1))),
            F.transform(children, lambda e: _note(tag, "child", e["key"])),
        )

    return (
        F.when(read.startswith("{"), _once(F.map_entries(_as_map(element)), of_object))
        .when(read.contains("x"), F.array(_note(tag, "text")))
        .otherwise(none)
    )


@F.pandas_udf(T.StringType())
def _balanced(fragments: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in fragments:
        yield series.map(balance_fragment, na_action="ignore")


def repaired_value(fragment: Column) -> Column:
    """The fragment, or its repaired form if it is malformed. Sends all rows through Python, most as nulls."""
    bad = is_malformed(fragment)
    return F.when(bad, _balanced(F.when(bad, fragment))).otherwise(fragment)


def _repaired(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with malformed fragments are split off, repaired and put back; only these reach Python."""
    if not columns:
        return df
    damaged = reduce(Column.__or__, [is_malformed(F.col(quoted(c))) for c in columns])
    bad = df.where(damaged)
    fixed = {c: repaired_value(F.col(quoted(c))) for c in columns}
    bad = bad.select(*[fixed[c].alias(c) if c in fixed else F.col(quoted(c)) for c in df.columns])
    return df.where(~damaged).unionAll(bad)


def repaired_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the malformed fragments of these columns repaired, whether or not there are any."""
    return _repaired(df, columns)


def repair_xml(df: DataFrame, *columns: str) -> DataFrame:
    """Make malformed fragments well-formed, keeping all that can be read.

    One scan finds the columns that need it; without any the table is returned
    as it is.
    """
    checks = [F.bool_or(is_malformed(F.col(quoted(c)))).alias(f"b{i}") for i, c in enumerate(columns)]
    row = df.agg(*checks).first()
    return _repaired(df, [c for i, c in enumerate(columns) if row[f"b{i}"]])


def nested_xml_columns(
    df: DataFrame, column: str, sep: str = "_", arrays: str = "first", repair: bool = True
) -> DataFrame:
    """Nested elements of one XML column as plain columns, level by level.

    ``<S><T>x</T><U>y</U></S>`` gives ``s_t`` and ``s_u``, attributes come as ``s@name``, and the
    text of an element that has attributes or children as ``s``. Names are lower-case.
    ``arrays`` says what becomes of repeated elements, as in ``flatten_nested``.
    The column itself is dropped; other columns stay, and keep their names if they clash.
    One scan over the fragments infers their schema, in which every leaf is text.
    """
    if repair:
        df = _repaired(df, [column])
    wrapped = F.concat(F.lit("<r>"), F.col(quoted(column)), F.lit("</r>"))
    options = {"attributePrefix": "@", "valueTag": "#", "ignoreNamespace": "false", "rowTag": "r", "inferSchema": "false"}
    texts = df.where(F.col(quoted(column)).isNotNull()).select(wrapped.alias("value"))
    spark = df.sparkSession
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    inferred = spark._jsparkSession.read().options(options).xml(strings).schema().json()
    schema = T.StructType.fromJson(json.loads(inferred))
    schema = T.StructType([f for f in schema if f.name not in ("_corrupt_record", "#")])
    others = [c for c in df.columns if c != column]
    if not schema.fields:
        return df.select(*[quoted(c) for c in others])
    # fields by place, as their names may be one to the session
    placed = T.StructType([T.StructField(f"p{k}", f.dataType) for k, f in enumerate(schema)])
    parsed = F.from_xml(wrapped, schema, options).cast(placed)
    fold = ignores_case(df)
    names = distinct_names([*others, *[f.name for f in schema]], fold)[len(others) :]
    flat = flatten_nested(
        df.select(*[F.col(quoted(c)) for c in others], parsed.alias("__x")).select(
            *[F.col(quoted(c)) for c in others],
            *[F.col("__x").getField(f"p{k}").alias(n) for k, n in enumerate(names)],
        ),
        sep,
        arrays,
    )
    found = flat.columns[len(others) :]
    short = [n.replace(f"{sep}@", "@").replace(f"{sep}#", "").lower() for n in found]
    return flat.toDF(*distinct_names([*others, *short], fold))


def malformed_fragments(df: DataFrame, id: str, column: str) -> DataFrame:
    """The malformed fragments with their repaired form."""
    bad = df.where(is_malformed(F.col(quoted(column)))).select(quoted(id), quoted(column))
    return bad.withColumn("repaired", _balanced(F.col(quoted(column))))
