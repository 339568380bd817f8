"""Dependencies and keys that the rows of a table follow, found rather than declared.

A set of columns determines another column if no two rows that agree in the set differ in it. Only
minimal dependencies are listed; all others follow from them. The search climbs the lattice of
column sets level by level. A candidate is skipped if a smaller set determines the column already,
or if one column of the set follows from the others. A bounded sample refutes most of the rest: two
of its rows that agree and differ do so in the whole table as well. The rows of a set fall into
classes by their values; one class in CLASSES_A_SAMPLE, with all its rows, refutes most of what is
left. Only what both leave open is tested on all rows, the sets of a level in one aggregation: a
class whose least and largest hash of the determined columns differ breaks a dependency, and only
then are the columns told apart. Rows dealt by one column have the classes of all sets with that
column in one task, so they are shuffled once for all of these, and not once for every set; where a
value of the column owns too many rows for a task, each set has a shuffle of its own.

Rows are compared by hashes, 128 bits for the sets. What reaches the driver is the sample and a few
numbers per tested set.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import hot_keys
from ledgerline.session import materialize

MAX_LEFT = 3
# rows of the sample per column
SAMPLE_ROWS = 2000
# sets whose classes are counted in one aggregation
SETS_AT_ONCE = 64
# one class in so many is looked at before all of them are
CLASSES_A_SAMPLE = 64
# so many sets with a common column are worth dealing all rows by that column
SETS_TO_DEAL = 3
ROWS_A_TASK = 200_000


@dataclass(frozen=True)
class Dependency:
    """Rows that agree in ``left`` agree in ``right``; ``n_values`` classes of rows were found."""

    left: tuple[str, ...]
    right: str
    n_values: int


@dataclass(frozen=True)
class Found:
    """What :func:`discover` found: minimal dependencies and minimal sets that identify a row."""

    columns: tuple[str, ...]
    dependencies: tuple[Dependency, ...]
    keys: tuple[tuple[str, ...], ...]


def _codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two 64-bit codes per column, a0, b0, a1, b1 and so on; NULL is a value of its own."""
    codes: list[Column] = []
    for at, name in enumerate(columns):
        parts = [F.col(f"`{name}`"), F.col(f"`{name}`").isNull()]
        codes.append(F.xxhash64(*parts).alias(f"a{at}"))
        codes.append(F.xxhash64(F.lit(1), *parts).alias(f"b{at}"))
    return df.select(*codes)


def _sample(codes: DataFrame, n_columns: int, rows: int) -> np.ndarray:
    """For every column the rows with its smallest codes, so that whole groups of equal values are among them."""
    names = [f"a{k}" for k in range(n_columns)]
    picked = [codes.select(*names).orderBy(name).limit(rows) for name in names]
    found = [np.array(p.collect(), np.int64).reshape(-1, n_columns) for p in picked]
    return np.unique(np.concatenate(found), axis=0)


class _Refuter:
    """Dependencies that the sample breaks."""

    def __init__(self, sample: np.ndarray):
        # small numbers in place of codes
        self.rows = np.stack([np.unique(c, return_inverse=True)[1] for c in sample.T], 1) if sample.size else sample
        self.classes: dict[tuple[int, ...], np.ndarray] = {}

    def _class(self, left: tuple[int, ...]) -> np.ndarray:
        if not left:
            return np.zeros(len(self.rows), np.int64)
        if left not in self.classes:
            # refine the classes of the set without its last column
            finer = self._class(left[:-1]) * (int(self.rows[:, left[-1]].max(initial=0)) + 1) + self.rows[:, left[-1]]
            self.classes[left] = np.unique(finer, return_inverse=True)[1]
        return self.classes[left]

    def breaks(self, left: tuple[int, ...], right: int) -> bool:
        if not len(self.rows):
            return False
        own = self._class(left)
        both = own * (int(self.rows[:, right].max()) + 1) + self.rows[:, right]
        return len(np.unique(both)) > int(own.max()) + 1


def _class_rows(codes: DataFrame, sets: Sequence[tuple[int, ...]], *more: Sequence[Column]) -> DataFrame:
    """One row per row and set: set, the hashes h1 and h2 of its class, and what ``more`` adds for the set."""

    def one(number: int, left: tuple[int, ...]) -> Column:
        own = [F.col(f"{ab}{k}") for k in left for ab in "ab"]
        hashes = [F.xxhash64(F.lit(2), *own).alias("h1"), F.xxhash64(F.lit(3), *own).alias("h2")]
        return F.struct(F.lit(number).alias("set"), *hashes, *[m[number] for m in more])

    return codes.select(F.inline(F.array(*[one(n, left) for n, left in enumerate(sets)])), "*")


def _refuted(codes: DataFrame, sets: Sequence[tuple[int, ...]], n_columns: int, one_in: int) -> dict[int, tuple]:
    """Per set that has rows in its sample of classes: whether one has several rows, and which columns differ in one."""
    values = [f"a{k}" for k in range(n_columns)]
    # a class is taken with all its rows, or not at all
    rows = _class_rows(codes, sets).filter(F.pmod("h2", F.lit(one_in)) == 0)
    classes = rows.groupBy("set", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), *[(F.min(v) != F.max(v)).alias(f"differ_{v}") for v in values]
    )
    found = classes.groupBy("set").agg(F.max("n").alias("rows"), *[F.max(f"differ_{v}").alias(v) for v in values])
    return {r["set"]: (r["rows"] > 1, [r[v] for v in values]) for r in found.collect()}


class _Rows:
    """The codes of a table, dealt by single columns where that spares shuffles."""

    def __init__(self, codes: DataFrame, n_columns: int):
        self.codes = codes
        spread = codes.agg(F.count(F.lit(1)), *[F.approx_count_distinct(f"a{k}") for k in range(n_columns)]).first()
        self.n, self.spread = spread[0], spread[1:]
        self.hot: dict[int, bool] = {}

    def _even(self, column: int) -> bool:
        """Whether no value of the column owns too many rows for one task."""
        if column not in self.hot:
            self.hot[column] = not hot_keys(self.codes, f"a{column}").isEmpty()
        return not self.hot[column]

    def place(self, left: tuple[int, ...]) -> int | None:
        """The column of a set by whose values rows are dealt, if there is a fit one."""
        return next((k for k in sorted(left, key=lambda k: -self.spread[k]) if self._even(k)), None)

    def dealt(self, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
        parts = int(self.codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return self.codes.select(*columns).repartition(max(parts, self.n // ROWS_A_TASK), *keys)


def _counted(table: _Rows, tests: Sequence[tuple[tuple[int, ...], list[int]]]) -> list[tuple[int, int, bool]]:
    """Per set and columns: how many classes the set has, the rows of the largest, and whether it determines the columns.

    Rows that are dealt by one column have all classes of all sets with that column in one task, so
    they are shuffled once for all these sets.
    """
    together: dict[int | None, list[int]] = {}
    for number, (left, _) in enumerate(tests):
        together.setdefault(table.place(left), []).append(number)
    out = [(0, 0, True)] * len(tests)
    for column, numbers in together.items():
        some = [tests[n] for n in numbers]
        own = [F.xxhash64(F.lit(4), *[F.col(f"a{k}") for k in rights]).alias("own") for _, rights in some]
        used = {f"{ab}{k}" for left, _ in some for k in left for ab in "ab"} | {f"a{k}" for _, rights in some for k in rights}
        keys: list[str] = []
        codes = table.codes
        if column is not None and len(some) >= SETS_TO_DEAL:
            keys = [f"a{column}", f"b{column}"]
            codes = table.dealt(sorted(used, key=lambda c: (int(c[1:]), c)), keys)
        rows = _class_rows(codes, [left for left, _ in some], own).select("set", *keys, "h1", "h2", "own")
        classes = rows.groupBy("set", *keys, "h1", "h2").agg(
            F.count(F.lit(1)).alias("n"), F.min("own").alias("least"), F.max("own").alias("most")
        )
        found = classes.groupBy("set").agg(
            F.count(F.lit(1)).alias("classes"), F.max("n").alias("rows"), F.max(F.col("least") != F.col("most")).alias("differ")
        )
        for r in found.collect():
            out[numbers[r["set"]]] = (r["classes"], r["rows"], not r["differ"])
    return out


def _tested(
    table: _Rows, wanted: dict[tuple[int, ...], list[int]], n_columns: int, one_in: int = CLASSES_A_SAMPLE
) -> dict[tuple[int, ...], tuple[int, bool, list[int]]]:
    """Per set of columns: how many classes it has, whether each has one row only, and which wanted columns it determines.

    Sets that do neither are left out.
    """
    sets = list(wanted)
    refuted = _refuted(table.codes, sets, n_columns, one_in)
    tests = []
    for number, left in enumerate(sets):
        several, differ = refuted.get(number, (False, [False] * n_columns))
        rights = [k for k in wanted[left] if not differ[k]]
        # a set without wanted columns may still be a key
        if rights or not (wanted[left] or several):
            tests.append((left, rights))
    out: dict[tuple[int, ...], tuple[int, bool, list[int]]] = {}
    while tests:
        apart = []
        for (left, rights), (n, rows, holds) in zip(tests, _counted(table, tests), strict=True):
            if holds:
                known = out.get(left, (n, rows <= 1, []))[2]
                out[left] = (n, rows <= 1, [*known, *rights])
            elif len(rights) > 1:
                apart += [(left, [k]) for k in rights]
        tests = apart
    return out


def discover(
    df: DataFrame, columns: Sequence[str] | None = None, max_left: int = MAX_LEFT, sample_rows: int = SAMPLE_ROWS
) -> Found:
    """All minimal dependencies with up to ``max_left`` columns on the left, and the keys of that size.

    NULL counts as a value. A column with one value everywhere depends on the empty set. In an
    empty table every column does, and the empty set is its key.
    """
    names = tuple(columns or df.columns)
    width = len(names)
    codes = materialize(_codes(df, names), "codes")
    table = _Rows(codes, width)
    refuter = _Refuter(_sample(codes, width, sample_rows))
    known: list[tuple[tuple[int, ...], int, int]] = []
    keys: list[tuple[int, ...]] = []

    def follows(left: Iterable[int], right: int) -> bool:
        have = set(left)
        return any(right == r and have.issuperset(own) for own, r, _ in known)

    for size in range(max_left + 1):
        candidates: dict[tuple[int, ...], list[int]] = {}
        for left in combinations(range(width), size):
            if any(set(left).issuperset(key) for key in keys):
                continue
            if any(follows([c for c in left if c != column], column) for column in left):
                continue
            open_ = [c for c in range(width) if c not in left and not follows(left, c)]
            wanted = [right for right in open_ if not refuter.breaks(left, right)]
            # a set that identifies rows determines every other column
            if wanted or not open_:
                candidates[left] = wanted
        sets = list(candidates)
        for first in range(0, len(sets), SETS_AT_ONCE):
            some = {left: candidates[left] for left in sets[first : first + SETS_AT_ONCE]}
            for left, (n, single, holds) in _tested(table, some, width).items():
                known += [(left, right, n) for right in holds]
                if single:
                    keys.append(left)
    dependencies = [Dependency(tuple(names[k] for k in left), names[right], n) for left, right, n in known]
    return Found(names, tuple(dependencies), tuple(tuple(names[k] for k in key) for key in keys))
