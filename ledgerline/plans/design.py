"""From dependencies to tables in third normal form.

The dependencies of a list are few and short, so the design is worked out in plain Python; only
finding them and cutting the list into tables touch rows. The result does not depend on the order
in which dependencies are listed: determinants that determine the same columns share a table, and a
table drops, from its last column to its first, what follows from the rest by determinants of less.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.dependencies import Found, discover

# left columns and the column they determine
Rule = tuple[Iterable[str], str]


@dataclass(frozen=True)
class Part:
    """A table of the design: its columns, in the list's order, its key, and what else could be its key."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    others: tuple[tuple[str, ...], ...] = ()

    def rules(self) -> list[Rule]:
        return [(key, c) for key in (self.key, *self.others) for c in self.columns]


def closure(columns: Iterable[str], rules: Sequence[Rule]) -> frozenset[str]:
    """All columns that follow from ``columns``."""
    have = set(columns)
    grown = True
    while grown:
        grown = False
        for left, right in rules:
            if right not in have and have.issuperset(left):
                have.add(right)
                grown = True
    return frozenset(have)


def minimal_rules(rules: Sequence[Rule]) -> list[tuple[frozenset[str], str]]:
    """The rules without columns on the left that follow from the others there, and without repeats."""
    slim = []
    for left, right in rules:
        own = sorted(left)
        for column in list(own):
            if right in closure([c for c in own if c != column], rules):
                own.remove(column)
        if right not in own:
            slim.append((frozenset(own), right))
    return list(dict.fromkeys(slim))


def whole_key(columns: Sequence[str], rules: Sequence[Rule]) -> tuple[str, ...]:
    """Columns from which all follow; later columns are dropped before earlier ones."""
    key = list(columns)
    for column in reversed(columns):
        rest = [c for c in key if c != column]
        if closure(rest, rules).issuperset(columns):
            key = rest
    return tuple(key)


def normal_form(columns: Sequence[str], rules: Sequence[Rule]) -> list[Part]:
    """Tables in third normal form that keep every dependency and give the list back when joined.

    ``rules`` may be found (:func:`~ledgerline.operators.dependencies.discover`) or declared. If no
    table identifies a row of the list, one with a key of the whole list is added. Columns with
    one value everywhere form a table with an empty key and one row.
    """
    place = {c: k for k, c in enumerate(columns)}

    def ordered(names: Iterable[str]) -> tuple[str, ...]:
        return tuple(sorted(names, key=place.__getitem__))

    slim = minimal_rules(rules)
    groups: dict[frozenset[str], list[frozenset[str]]] = {}
    for left, _ in slim:
        own = groups.setdefault(closure(left, slim), [])
        if left not in own:
            own.append(left)

    reaches = {left: closure(left, slim) for left, _ in slim}
    parts = []
    for reach, lefts in groups.items():
        # what determinants that reach less give need not be repeated here
        lower = [(left, right) for left, right in slim if reaches[left] < reach]
        keyed = frozenset().union(*lefts)
        kept = set(reach)
        for column in reversed(ordered(reach - keyed)):
            if column in closure(kept - {column}, lower):
                kept.remove(column)
        key, *others = sorted((ordered(left) for left in lefts), key=lambda k: (len(k), [place[c] for c in k]))
        parts.append(Part(ordered(kept), key, tuple(others)))
    if not any(closure(p.columns, slim).issuperset(columns) for p in parts):
        key = whole_key(columns, slim)
        parts.append(Part(key, key))
    return sorted(parts, key=lambda p: (-len(p.columns), p.columns))


def rules_of(found: Found) -> list[Rule]:
    return [(d.left, d.right) for d in found.dependencies]


def found_design(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 3) -> list[Part]:
    """The design that the rows of ``df`` themselves suggest."""
    found = discover(df, columns, max_left)
    return normal_form(found.columns, rules_of(found))


def decompose(df: DataFrame, parts: Sequence[Part]) -> list[DataFrame]:
    """The tables of a design: the distinct rows of the list in their columns."""
    return [df.select(*[F.col(f"`{c}`") for c in p.columns]).distinct() for p in parts]


def recompose(parts: Sequence[Part], tables: Sequence[DataFrame]) -> DataFrame:
    """The distinct rows of the list, joined from its tables; NULLs in keys match.

    The table that identifies a row of the list comes first; every other one is joined as soon as
    its key is there, so no join adds rows.
    """
    left = list(zip(parts, tables, strict=True))
    every = {c for p in parts for c in p.columns}
    rules = [rule for p in parts for rule in p.rules()]
    first = next(k for k, (p, _) in enumerate(left) if closure(p.columns, rules) >= every)
    part, out = left.pop(first)
    have = set(part.columns)
    while left:
        at, key = next((k, key) for k, (p, _) in enumerate(left) for key in (p.key, *p.others) if have.issuperset(key))
        part, table = left.pop(at)
        new = [c for c in part.columns if c not in have]
        if not new:
            continue
        if not key:
            # one row
            row = table.first()
            for c in new:
                value = F.lit(None if row is None else row[c]).cast(table.schema[c].dataType)
                out = out.withColumn(c, value)
        else:
            wanted = table.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in key], *[F.col(f"`{c}`") for c in new])
            same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__{c}")) for c in key]
            out = out.join(wanted, same).drop(*[f"__{c}" for c in key])
        have.update(new)
    return out


def design_table(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 3) -> DataFrame:
    """The design of a list, one row per table: its columns, its key and how many rows it has."""
    spark = df.sparkSession
    parts = found_design(df, columns, max_left)
    names = ", ".join
    counts = [t.count() for t in decompose(df, parts)]
    rows = [(names(p.columns), names(p.key), n) for p, n in zip(parts, counts, strict=True)]
    return spark.createDataFrame(rows, "columns string, key string, n_rows bigint")


def dependency_table(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 3) -> DataFrame:
    """The minimal dependencies of a list, one row each."""
    found = discover(df, columns, max_left)
    rows = [(", ".join(d.left), d.right, d.n_values) for d in found.dependencies]
    return df.sparkSession.createDataFrame(rows, "determinant string, dependent string, n_values bigint")
