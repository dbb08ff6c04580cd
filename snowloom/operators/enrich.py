"""Joins that add ids and attributes: lookups, chains, fallbacks, parents, roles, rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowloom.functions import in_list, null_safe_equal, trimmed
from snowloom.operators.skew import salted_join
from snowloom.session import materialize


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) for c in on]


def _named(take: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(take) if isinstance(take, Mapping) else {c: c for c in take}


def one_per_key(dim: DataFrame, keys: Sequence[Column], value: str) -> DataFrame:
    """Reduce a dimension to the lowest ``value`` of each key, before any row is joined to it."""
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    present = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    return dim.where(present).groupBy(*named).agg(F.min(value).alias(value))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    take: Sequence[str] | Mapping[str, str],
    how: str = "left",
    lowest: bool = False,
    salted: bool = False,
) -> DataFrame:
    """Add columns of a dimension to every row.

    ``on`` maps columns of ``df`` to columns of ``dim``; text keys are compared without surrounding
    blanks, null keys never match. ``take`` names the columns to add, or maps them to new names.
    Several dimension rows per key give several rows, unless ``lowest`` asks for the lowest value of
    the single column taken. No broadcast is forced: Spark broadcasts by the size it knows or measures.
    ``salted`` spreads heavy keys explicitly (see ``skew``).
    """
    on, take = _pairs(on), _named(take)
    clash = [name for name in take.values() if name in df.columns]
    if clash:
        raise ValueError(f"columns already present: {clash}")
    keys = [trimmed(dim, right) for _, right in on]
    if lowest:
        ((source, name),) = take.items()
        right = one_per_key(dim, keys, source).withColumnRenamed(source, name)
    else:
        right = dim.select(
            *[k.alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(source).alias(name) for source, name in take.items()],
        )
    if salted:
        left = df.withColumns({f"__l{i}": trimmed(df, a) for i, (a, _) in enumerate(on)})
        joined = salted_join(left, right, [(f"__l{i}", f"__k{i}") for i in range(len(on))], how)
    else:
        condition = reduce(
            lambda a, b: a & b, [trimmed(df, a) == F.col(f"__k{i}") for i, (a, _) in enumerate(on)]
        )
        joined = df.join(right, condition, how)
    return joined.select(*df.columns, *take.values())


@dataclass(frozen=True)
class Step:
    """One lookup of a chain."""

    dim: DataFrame
    on: str | Sequence[str] | Mapping[str, str]
    take: Sequence[str] | Mapping[str, str]
    how: str = "left"


def lookup_chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Lookups one after the other; a step may use what an earlier one added."""
    for step in steps:
        df = lookup(df, step.dim, step.on, step.take, step.how)
    return df


@dataclass(frozen=True)
class Candidate:
    """One way to find a value: where to look, by which columns, what to take."""

    dim: DataFrame
    on: Mapping[str, str]
    value: str


def first_match(df: DataFrame, candidates: Sequence[Candidate], target: str) -> DataFrame:
    """Add the value of the first candidate that finds one.

    Every dimension is first reduced to one value per key. The candidates are tried on the *distinct*
    references, not on the rows: a reference that a third of the rows share is resolved once, and the
    rows join once to the resolved references instead of once per candidate.
    """
    needed = list(dict.fromkeys(c for candidate in candidates for c in candidate.on))
    refs = df.select(*needed).distinct()
    found = []
    for i, candidate in enumerate(candidates):
        name = f"__found{i}"
        refs = lookup(refs, candidate.dim, candidate.on, {candidate.value: name}, lowest=True)
        found.append(F.col(name))
    refs = refs.select(
        *[F.col(c).alias(f"__r{i}") for i, c in enumerate(needed)], F.coalesce(*found).alias(target)
    )
    refs = materialize(refs, "references")
    joined = df.join(refs, null_safe_equal([(c, f"__r{i}") for i, c in enumerate(needed)]), "left")
    return joined.select(*df.columns, target)


def with_parent(df: DataFrame, key: str, parent: str, attributes: Mapping[str, str]) -> DataFrame:
    """Add attributes of the parent row of the same table; a row without a parent gives its own."""
    parents = df.select(
        F.col(key).alias("__key"), *[F.col(source).alias(f"__a{i}") for i, source in enumerate(attributes)]
    )
    joined = df.join(parents, F.col(parent) == F.col("__key"), "left")
    own = [
        F.coalesce(F.col(f"__a{i}"), F.col(source)).alias(name) for i, (source, name) in enumerate(attributes.items())
    ]
    return joined.select(*df.columns, *own)


def role_lookup(
    df: DataFrame, dim: DataFrame, foreign: str, key: str, prefix: str, attributes: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Join one dimension in one of its roles; its attributes get the role as a prefix."""
    return lookup(df, dim, {foreign: key}, {source: f"{prefix}{name}" for source, name in _named(attributes).items()})


def outer_match(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], keep_left: Sequence[str], keep_right: Sequence[str]
) -> DataFrame:
    """Match two lists and keep what either side has alone.

    Both sides are made distinct first: a full outer join cannot be split when one key is heavy.
    """
    a = left.select(*dict.fromkeys([*on, *keep_left])).distinct()
    b = right.select(*dict.fromkeys([*on.values(), *keep_right])).distinct()
    a = a.withColumns({f"__a{i}": trimmed(a, c) for i, c in enumerate(on)})
    b = b.withColumns({f"__b{i}": trimmed(b, c) for i, c in enumerate(on.values())})
    condition = reduce(lambda x, y: x & y, [F.col(f"__a{i}") == F.col(f"__b{i}") for i in range(len(on))])
    return a.join(b, condition, "full_outer").select(*keep_left, *keep_right)


def missing(df: DataFrame, dim: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The rows whose key the dimension does not have; a null key counts as missing."""
    on = _pairs(on)
    right = dim.select(*[trimmed(dim, b).alias(f"__k{i}") for i, (_, b) in enumerate(on)]).distinct()
    condition = reduce(lambda a, b: a & b, [trimmed(df, a) == F.col(f"__k{i}") for i, (a, _) in enumerate(on)])
    return df.join(right, condition, "left_anti")


@dataclass(frozen=True)
class ParentRule:
    """Which rows the rule takes and which row is their parent.

    ``when`` and ``unless`` map columns to patterns (see ``in_list``); all of ``when`` must hold and
    none of ``unless``. ``parent`` maps columns to the values that identify the parent.
    """

    when: Mapping[str, Sequence[str]]
    parent: Mapping[str, str]
    unless: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not (self.when or self.unless):
            raise ValueError("a rule needs a condition")
        if not self.parent:
            raise ValueError("a rule names its parent by at least one column")

    def condition(self) -> Column:
        tests = [in_list(F.col(c), patterns) for c, patterns in self.when.items()]
        tests += [~in_list(F.col(c), patterns) for c, patterns in self.unless.items()]
        return reduce(lambda a, b: a & b, tests)


def resolve_parent(
    df: DataFrame, rules: Sequence[ParentRule], dim: DataFrame, id_column: str, target: str
) -> DataFrame:
    """Add the id of the parent that the first fitting rule names.

    One ``CASE`` gives the number of the rule. The parents the rules name are looked up in ``dim`` by the
    columns each rule uses, which leaves at most one row per rule; both small sides are bounded by the list of
    rules and not by the data. If several rows fit a parent, the lowest id is taken.
    """
    if not rules:
        return df.withColumn(target, F.lit(None).cast(dim.schema[id_column].dataType))
    parents = _wanted(df, rules, dim, id_column, target)
    chosen = F
    for i, rule in enumerate(rules):
        chosen = chosen.when(rule.condition(), F.lit(i))
    kept = [c for c in df.columns if c != target]
    numbered = df.select(*kept).withColumn("__rule", chosen)
    joined = numbered.join(F.broadcast(parents), F.col("__rule") == F.col("__of"), "left")
    return joined.select(*kept, target)


def _wanted(df: DataFrame, rules: Sequence[ParentRule], dim: DataFrame, id_column: str, target: str) -> DataFrame:
    """``(__of, target)``: the lowest id of the parent that each rule names; a row per rule at most."""
    by_columns: dict[tuple[str, ...], list[int]] = {}
    for i, rule in enumerate(rules):
        by_columns.setdefault(tuple(sorted(rule.parent)), []).append(i)
    found = []
    for columns, numbers in by_columns.items():
        wanted = df.sparkSession.createDataFrame(
            [(i, *[rules[i].parent[c] for c in columns]) for i in numbers],
            "__rule int, " + ", ".join(f"__p{j} string" for j in range(len(columns))),
        )
        same = reduce(lambda a, b: a & b, [F.trim(F.col(c)) == F.col(f"__p{j}") for j, c in enumerate(columns)])
        places = dim.select(F.col(id_column).alias("__id"), *columns)
        found.append(places.join(F.broadcast(wanted), same).select("__rule", "__id"))
    return reduce(DataFrame.unionByName, found).groupBy(F.col("__rule").alias("__of")).agg(F.min("__id").alias(target))


def _literal(pattern: str) -> tuple[str, str] | None:
    """How a pattern can be found by equality: ``whole``, or a text's beginning or end; null if it cannot."""
    if "%" not in pattern:
        return "whole", pattern
    if "\\" in pattern:
        return None
    start, end = re.split("[%_]", pattern)[0], re.split("[%_]", pattern)[-1]
    if not start and not end:
        return None
    return ("start", start) if len(start) >= len(end) else ("end", end)


class RuleIndex:
    """Rules by the values, beginnings and ends of texts that they ask for.

    Each rule stands under the patterns of one of its columns, the one whose shortest literal is longest. A rule whose every
    column has a pattern without a literal, or that only says what must not be, stays outside and is tried on all.
    """

    def __init__(self, rules: Sequence[ParentRule]):
        self.columns = sorted({c for r in rules for c in (*r.when, *r.unless)})
        self.entries: list[tuple[int, str, str, int]] = []
        self.outside: list[int] = []
        for i, rule in enumerate(rules):
            ways = []
            for column, patterns in rule.when.items():
                literals = [_literal(p) for p in patterns]
                if literals and all(literals):
                    ways.append((min(len(text) for _, text in literals), column, literals))
            if not ways:
                self.outside.append(i)
                continue
            _, column, literals = max(ways, key=lambda w: (w[0], w[1]))
            at = self.columns.index(column)
            self.entries += [(at, kind, text, i) for kind, text in dict.fromkeys(literals)]
        self.lengths = {(at, kind, len(text)) for at, kind, text, _ in self.entries}

    def probes(self, values: Column) -> Column:
        """What to look for in the index of a row's values: as many as there are lengths of literals, not rules."""
        found = []
        for at, kind, n in sorted(self.lengths, key=str):
            value = F.get(values, F.lit(at))
            text = F.trim(value) if kind == "whole" else F.substring(value, 1, n) if kind == "start" else F.right(value, F.lit(n))
            found.append(F.when(F.char_length(text) == n, F.struct(F.lit(at).alias("at"), F.lit(kind).alias("kind"), text.alias("text"))))
        return F.array_compact(F.array(*found))


def resolve_parent_indexed(
    df: DataFrame, rules: Sequence[ParentRule], dim: DataFrame, id_column: str, target: str
) -> DataFrame:
    """``resolve_parent`` for very many rules: the work does not grow with their number.

    Different values of the columns that rules ask for are looked up in the index by equality, which leaves the few rules
    that may fit; their patterns are tried on these alone, as data, and the first that fits counts. The index
    has a row for each literal of the rules and is bounded by them.
    """
    if not rules:
        return resolve_parent(df, rules, dim, id_column, target)
    spark, index = df.sparkSession, RuleIndex(rules)
    kept = [c for c in df.columns if c != target]
    parents = _wanted(df, rules, dim, id_column, target)
    texts = materialize(df.select(F.array(*[F.col(c).cast("string") for c in index.columns]).alias("__values")).distinct(), "rule-texts")

    conditions = [
        (i, [(index.columns.index(c), False, list(p)) for c, p in r.when.items()] + [(index.columns.index(c), True, list(p)) for c, p in r.unless.items()])
        for i, r in enumerate(rules)
    ]
    asked = spark.createDataFrame(conditions, "__rule int, __asked array<struct<at:int,never:boolean,patterns:array<string>>>")
    entries = spark.createDataFrame(index.entries, "at int, kind string, text string, __rule int") if index.entries else None
    candidates = []
    if entries is not None:
        probes = texts.select("__values", F.explode(index.probes(F.col("__values"))).alias("p")).select("__values", "p.*")
        candidates.append(probes.join(F.broadcast(entries), ["at", "kind", "text"]).select("__values", "__rule"))
    if index.outside:
        some = F.explode(F.array(*[F.lit(i) for i in index.outside]))
        candidates.append(texts.select("__values", some.alias("__rule")))

    def holds(c: Column) -> Column:
        value = F.get(F.col("__values"), c["at"])
        fits = F.exists(c["patterns"], lambda p: F.when(p.contains("%"), F.like(value, p)).otherwise(F.trim(value) == p))
        return F.coalesce(fits != c["never"], F.lit(False))

    tried = reduce(DataFrame.unionByName, candidates).distinct().join(F.broadcast(asked), "__rule")
    first = tried.where(F.forall("__asked", holds)).groupBy("__values").agg(F.min("__rule").alias("__rule"))
    chosen = first.join(F.broadcast(parents), F.col("__rule") == F.col("__of")).select(F.col("__values").alias("__chosen"), target)
    keyed = df.select(*kept).withColumn("__values", F.array(*[F.col(c).cast("string") for c in index.columns]))
    return keyed.join(chosen, F.col("__values") == F.col("__chosen"), "left").select(*kept, target)
