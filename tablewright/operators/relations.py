"""How columns of one table determine each other, and the tables that follow."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, permutations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.values import (
    KEY,
    TIME,
    canonical_text,
    family_of,
    has_key,
    is_exactly_sortable,
    quoted,
    sortable,
    value_key,
)
from tablewright.operators.cleaning import keep_columns, without_columns
from tablewright.operators.profile import (
    ColumnCounts,
    column_counts,
    column_types,
    merge_pairs,
    pairwise_equality,
    stack_rows,
    stack_values,
    unique_columns,
)
from tablewright.operators.ranking import with_row_number


class Dependency(NamedTuple):
    """Column ``a`` fixes column ``b``.

    ``lossless`` adds that nulls obey it too, so that ``b`` can be rebuilt
    from ``a`` alone.
    """

    a: str
    b: str
    lossless: bool


class Relations(NamedTuple):
    counts: ColumnCounts
    keys: list[str]
    identical: list[list[str]]
    dependencies: dict[tuple[str, str], Dependency]
    ndv: dict[str, int]  # of the determinants that are no keys

    def kind(self, a: str, b: str) -> str:
        if any(a in group and b in group for group in self.identical):
            return "identical"
        if (a, b) not in self.dependencies:
            return "none"
        return "bijective" if (b, a) in self.dependencies else "surjective"


class _Verdict(NamedTuple):
    kept: list[Dependency]
    repeating: set[str]
    ndv: dict[str, int]


def _slot_value(name: str, dtype: T.DataType) -> Column:
    """``sortable`` as a double for fractional numbers and as a bigint for all else."""
    if family_of(dtype) == TIME:
        return F.unix_micros(F.col(quoted(name)).cast("timestamp"))
    return sortable(name, dtype).cast("double" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "bigint")


class _Unit(NamedTuple):
    """A determinant and some of its targets, which share a row of the stacked table."""

    determinant: str
    wholes: list[str]  # in the order of their slots
    reals: list[str]


def _units(pairs: Sequence[tuple[str, str]], is_real: dict[str, bool]) -> list[_Unit]:
    """Deal each determinant's own targets to units of one width, the one that shuffles least.

    A stacked row costs its key (three values and its head) and all slots of its unit, also those
    that stay empty, so few wide units suit many targets, and narrow ones a few targets for each.
    """
    targets: dict[str, tuple[list[str], list[str]]] = {}
    for a, b in pairs:
        targets.setdefault(a, ([], []))[is_real[b]].append(b)

    def slots(width: tuple[int, int]) -> int:
        # a determinant's units, times what a row of them takes
        units = sum(max(1, *(-(-len(t) // w) if w else 0 for t, w in zip(own, width))) for own in targets.values())
        return units * (sum(width) + 4)

    most = [max(len(own[k]) for own in targets.values()) for k in (0, 1)]
    widths = [sorted({min(m, 1 << e) for e in range(m.bit_length() + 1)}) if m else [0] for m in most]
    width = min(((w, r) for w in widths[0] for r in widths[1]), key=slots)
    units = []
    for a, own in targets.items():
        cut = [[t[k : k + w] for k in range(0, len(t), w)] if w else [] for t, w in zip(own, width)]
        for k in range(max(1, *map(len, cut))):
            units.append(_Unit(a, *(c[k] if k < len(c) else [] for c in cut)))
    return units


def _refute(df: DataFrame, pairs: Sequence[tuple[str, str]], slice_only: bool) -> _Verdict:
    """Drop the pairs (a, b) for which some value of a meets two values of b.

    All determinants share one shuffle keyed by (determinant, value). Each row
    is stacked once per determinant and carries the targets that are still
    open for just this one (``_units``): the work follows the number of open pairs. It
    folds into its group's smallest and
    largest b before the shuffle: a hot value is one row per task, and no list
    of values is ever built. Also tells which determinants repeat a value.
    """
    if not pairs:
        return _Verdict([], set(), {})
    types = column_types(df)
    is_real = {b: isinstance(types[b], (T.FloatType, T.DoubleType)) for _, b in pairs}
    units = _units(pairs, is_real)
    targets = list(dict.fromkeys(b for _, b in pairs))
    payload = [_slot_value(b, types[b]).alias(f"b{j}") for j, b in enumerate(targets)]
    at = {b: f"b{j}" for j, b in enumerate(targets)}
    widths = [max(len(u[k]) for u in units) for k in (1, 2)]
    names = [f"{kind}{k}" for kind, w in zip("wr", widths) for k in range(w)]
    empty = {"w": "CAST(NULL AS BIGINT)", "r": "CAST(NULL AS DOUBLE)"}
    stacked = stack_values(df, [u.determinant for u in units], payload, slice_only)
    # the slots of a unit take its own targets, by the number of the unit
    slots = []
    for name in names:
        kind, k = 1 if name[0] == "w" else 2, int(name[1:])
        held: dict[str, list[int]] = {}
        for i, unit in enumerate(units):
            if k < len(unit[kind]):
                held.setdefault(at[unit[kind][k]], []).append(i)
        cases = " ".join(f"WHEN position IN ({', '.join(map(str, who))}) THEN {b}" for b, who in held.items())
        slots.append(F.expr(f"CASE {cases} ELSE {empty[name[0]]} END AS {name}"))
    long = stacked.select("position", *KEY, *slots)
    folded = [
        F.expr(text)
        for c in names
        for text in (f"min({c}) AS lo_{c}", f"max({c}) AS hi_{c}", f"count({c}) AS c_{c}")
    ]
    groups = long.groupBy("position", *KEY).agg(F.expr("count(1) AS n"), *folded)
    groups = groups.withColumn("known", has_key())
    checks = [F.expr("count_if(known) AS ndv"), F.expr("bool_or(known AND n > 1) AS repeats")]
    checks += [
        F.expr(text)
        for c in names
        for text in (
            f"count_if(known AND lo_{c} <> hi_{c}) AS broken_{c}",
            f"count_if(known AND c_{c} > 0) AS met_{c}",
            f"count_if(c_{c} > 0 AND (NOT known OR c_{c} < n)) AS torn_{c}",
        )
    ]
    verdicts = {r["position"]: r for r in groups.groupBy("position").agg(*checks).collect()}
    slot_of = {
        (unit.determinant, b): (i, f"{kind}{k}")
        for i, unit in enumerate(units)
        for kind, own in zip("wr", unit[1:])
        for k, b in enumerate(own)
    }
    kept = []
    for a, b in pairs:
        i, c = slot_of[a, b]
        row = verdicts.get(i)
        if row is None:  # no value in the slice
            kept.append(Dependency(a, b, True))
        elif row[f"broken_{c}"] == 0 and (slice_only or row[f"met_{c}"] > 0):
            kept.append(Dependency(a, b, row[f"torn_{c}"] == 0))
    return _Verdict(
        kept,
        {units[i].determinant for i, r in verdicts.items() if r["repeats"]},
        {units[i].determinant: r["ndv"] for i, r in verdicts.items()},
    )


def _confirm_text(df: DataFrame, found: Sequence[Dependency]) -> list[Dependency]:
    """Recheck dependencies of text columns, which were compared by hash, on the text itself."""
    types = column_types(df)
    hashed = [d for d in found if not is_exactly_sortable(types[d.b])]
    if not hashed:
        return list(found)
    cells = [
        (F.lit(i), *value_key(d.a, types[d.a]), canonical_text(d.b, types[d.b]))
        for i, d in enumerate(hashed)
    ]
    long = df.select(stack_rows(cells, ["pair", *KEY, "b"])).where(has_key() & F.col("b").isNotNull())
    met = long.groupBy("pair", *KEY, "b").count()
    broken = met.groupBy("pair", *KEY).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    refuted = {hashed[r["pair"]] for r in broken.select("pair").distinct().collect()}
    return [d for d in found if d not in refuted]


def exact_dependencies(
    df: DataFrame, pairs: Sequence[tuple[str, str]]
) -> dict[tuple[str, str], Dependency]:
    """Which of the pairs (a, b) hold on every row, see ``Dependency``."""
    found = _confirm_text(df, _refute(df, pairs, slice_only=False).kept)
    return {(d.a, d.b): d for d in found}


def find_relations(df: DataFrame, counts: ColumnCounts | None = None) -> Relations:
    """Keys, identical columns and dependencies of a table.

    One pass over a slice of the values refutes most pairs and most keys. What
    is left is checked on all rows. A key fixes every column, which needs no
    counting, and only columns that fix each other can be identical.
    """
    counts = counts or column_counts(df)
    if counts.rows == 0:
        return Relations(counts, [], [], {}, {})
    present = [name for name in df.columns if counts.non_null[name] > 0]
    first = _refute(df, list(permutations(present, 2)), slice_only=True)
    complete = [c for c in present if counts.non_null[c] == counts.rows]
    keys = unique_columns(df, [c for c in complete if c not in first.repeating])
    found = {(a, b): Dependency(a, b, True) for a in keys for b in present if a != b}
    rest = _refute(df, [(d.a, d.b) for d in first.kept if d.a not in keys], slice_only=False)
    found.update({(d.a, d.b): d for d in _confirm_text(df, rest.kept)})
    mutual = [
        (a, b) for a, b in combinations(complete, 2) if (a, b) in found and (b, a) in found
    ]
    identical = []
    if mutual:
        equal = pairwise_equality(df, mutual).where("identical").collect()
        identical = merge_pairs(df.columns, [(r["col1"], r["col2"]) for r in equal])
    return Relations(counts, keys, identical, found, rest.ndv)


def column_relationships(df: DataFrame, relations: Relations | None = None) -> DataFrame:
    """For every ordered pair (a, b): does a fix b, and what kind of pair is it.

    Rows where either is null do not count. ``surjective`` means many-to-one
    from a onto b.
    """
    relations = relations or find_relations(df)
    rows = [
        (a, b, (a, b) in relations.dependencies, relations.kind(a, b))
        for a in df.columns
        for b in df.columns
        if a != b
    ]
    return df.sparkSession.createDataFrame(
        rows, "col_a string, col_b string, determines boolean, kind string"
    )


def bijective_mapping(df: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct value pairs that occur together; one of the two may serve as foreign key."""
    return keep_columns(df, [a, b]).dropna().distinct()


def positional_mapping(df: DataFrame, a: str, b: str, order_by: str) -> DataFrame:
    """Pair the n-th distinct value of ``a`` with the n-th of ``b``, by first appearance.

    First appearance means the smallest ``order_by``; the value breaks ties.
    """

    def ranked(name: str, alias: str) -> DataFrame:
        value = F.col(quoted(name)).alias(alias)
        first = (
            df.where(F.col(quoted(name)).isNotNull())
            .groupBy(value)
            .agg(F.min(quoted(order_by)).alias("__first"))
        )
        return with_row_number(first, ["__first", alias], name="rank").drop("__first")

    left, right = ranked(a, a), ranked(b, "__b")
    return left.join(right, "rank").select("rank", quoted(a), F.col("__b").alias(b))


class Split(NamedTuple):
    """A table without the split-off columns, and the lookup table for them."""

    table: DataFrame
    lookup: DataFrame


def lookup_table(df: DataFrame, keep: str, drop: str) -> Split:
    """Move ``drop`` into a lookup table keyed by ``keep``; all rows stay."""
    return Split(without_columns(df, [drop]).table, bijective_mapping(df, keep, drop))


class Star(NamedTuple):
    """Fact table, and per kept column the lookup table of what it fixes."""

    fact: DataFrame
    lookups: dict[str, DataFrame]
    keeper_of: dict[str, str]
    columns: list[str]

    def rebuild(self) -> DataFrame:
        """Join everything back; lookups of columns that sit in other lookups come later."""
        table, waiting = self.fact, dict(self.lookups)
        while waiting:
            keeper = next(k for k in waiting if k in table.columns)
            lookup = waiting.pop(keeper)
            found = lookup.withColumnRenamed(keeper, "__key")
            table = table.join(
                found, F.col(quoted(keeper)) == F.col("__key"), "left"
            ).drop("__key")
        return keep_columns(table, self.columns)


def choose_keepers(columns: Sequence[str], relations: Relations) -> dict[str, str]:
    """For each column to split off, the column that stays and fixes it.

    Of one-to-one columns the first stays. A column fixed many-to-one goes to
    the determinant with the fewest values, which gives the smallest lookup.
    Keys fix everything and would only rename the table, so they keep nothing
    but their one-to-one partners. Only lossless pairs are used.
    """
    sound = {pair for pair, d in relations.dependencies.items() if d.lossless}
    mutual = [(a, b) for a, b in combinations(columns, 2) if {(a, b), (b, a)} <= sound]
    keeper_of: dict[str, str] = {}
    for group in merge_pairs(columns, mutual):
        keeper_of.update(dict.fromkeys(group[1:], group[0]))
    place = {name: i for i, name in enumerate(columns)}
    heads = [name for name in columns if name not in keeper_of]
    for b in heads:
        options = [a for a in heads if (a, b) in sound and a not in relations.keys]
        if options:
            keeper_of[b] = min(options, key=lambda a: (relations.ndv[a], place[a]))
    return keeper_of


def _torn_by_nan(df: DataFrame, keeper_of: dict[str, str]) -> list[str]:
    """Float columns that hold both NaN and other values, null included, for one value of their keeper.

    Elsewhere NaN reads as null; a rebuilt table has to tell them apart.
    """
    types = column_types(df)
    pairs = [(b, a) for b, a in keeper_of.items() if types[b].typeName() in ("float", "double")]
    if not pairs:
        return []
    cells = [
        (F.lit(i), *value_key(a, types[a]), F.coalesce(F.isnan(F.col(quoted(b))), F.lit(False)))
        for i, (b, a) in enumerate(pairs)
    ]
    long = df.select(stack_rows(cells, ["pair", *KEY, "nan"]))
    met = long.groupBy("pair", *KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if("nan").alias("nans"))
    torn = met.where((F.col("nans") > 0) & ((F.col("nans") < F.col("n")) | ~has_key() | F.isnan("dbl")))
    return [pairs[r["pair"]][0] for r in torn.select("pair").distinct().collect()]


def star_schema(
    df: DataFrame, relations: Relations | None = None, confirm: bool = False
) -> Star:
    """Split one-to-one and many-to-one columns off into lookup tables.

    Every column is dropped at most once, and ``rebuild`` returns the input:
    each lookup has one row for each value of its keeper.
    ``confirm`` checks the chosen pairs on ``df`` itself, for relations that
    were found on a standardised copy of it.
    """
    relations = relations or find_relations(df)
    keeper_of = choose_keepers(df.columns, relations)
    for b in _torn_by_nan(df, keeper_of):
        del keeper_of[b]
    if confirm:
        held = exact_dependencies(df, [(a, b) for b, a in keeper_of.items()])
        keeper_of = {b: a for b, a in keeper_of.items() if (a, b) in held and held[a, b].lossless}
    lookups = {}
    for keeper in dict.fromkeys(keeper_of[c] for c in df.columns if c in keeper_of):
        fixed = [c for c in df.columns if keeper_of.get(c) == keeper]
        lookups[keeper] = keep_columns(df, [keeper, *fixed]).dropna(subset=[keeper]).distinct()
    fact = without_columns(df, list(keeper_of)).table
    return Star(fact, lookups, keeper_of, df.columns)
