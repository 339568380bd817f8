"""Declarative rules as DataFrames of violations; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.model import TABLES, Table


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with equal columns, built pairwise.

    Every union analyzes its inputs again; pairs keep that to a few levels.
    """
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].union(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or contain a NULL, with their row count."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | _any_null(key))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated values among rows in which all columns are set."""
    counts = df.filter(~_any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def check_violations(df: DataFrame, key: Sequence[str], checks: dict[str, str]) -> DataFrame:
    """One row per row and failed condition; a condition that is NULL passes."""
    failed = F.array(
        *[F.when(F.coalesce(~F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in checks.items()]
    )
    rules = F.filter(failed, lambda name: name.isNotNull())
    return df.select(*key, F.explode(rules).alias("rule"))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with the number of child rows.

    Children are reduced to one row per value before the join, so a value that
    owns most of the rows costs no more than any other.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key_value"))
    return used.join(parents, "key_value", "left_anti")


def restrict_blockers(
    deleted: DataFrame, parent_key: str, child: DataFrame, column: str
) -> DataFrame:
    """Deleted parents that children still refer to, with the number of children."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(deleted.select(F.col(parent_key).alias("key_value")), "key_value", "left_semi")


def cascade_survivors(lines: DataFrame, column: str, deleted: DataFrame, parent_key: str) -> DataFrame:
    """The lines left after their headers were deleted."""
    gone = deleted.select(F.col(parent_key).alias(column)).distinct()
    return lines.join(gone, column, "left_anti")


def cascade_deletes(lines: DataFrame, column: str, deleted: DataFrame, parent_key: str) -> DataFrame:
    """The lines that go with their deleted headers."""
    gone = deleted.select(F.col(parent_key).alias(column)).distinct()
    return lines.join(gone, column, "left_semi")


def fd_violations(df: DataFrame, determinant: Sequence[str], dependent: Sequence[str]) -> DataFrame:
    """Determinant values that go with more than one dependent value."""
    values = F.struct(*dependent)
    counts = df.groupBy(*determinant).agg(F.count_distinct(values).alias("n_values"))
    return counts.filter(F.col("n_values") > 1)


def stored_mismatch(
    stored: DataFrame, derived: DataFrame, key: str, stored_column: str, derived_column: str
) -> DataFrame:
    """Rows whose stored value differs from the derived one; both have one row per key."""
    both = stored.select(key, stored_column).join(derived.select(key, derived_column), key, "left")
    return both.filter(~F.col(stored_column).eqNullSafe(F.col(derived_column)))


def rule_counts(frames: dict[str, DataFrame], tables: dict[str, Table] = TABLES) -> DataFrame:
    """Violation count of every declared rule: table_name, rule, n_violations.

    Rules on columns a frame does not carry are skipped. NULL and condition
    rules of a table share one scan; each key or reference adds an aggregate.
    """
    results = []
    for name, df in frames.items():
        table = tables[name]
        have = set(df.columns)
        required = [c for c in (*table.key, *table.required) if c in have]
        tests: dict[str, Column] = {f"required:{c}": F.col(c).isNull() for c in required}
        for rule, condition in table.checks.items():
            tests[f"check:{rule}"] = F.coalesce(~F.expr(condition), F.lit(False))
        if tests:
            row = df.agg(*[F.count_if(t).alias(f"t{i}") for i, t in enumerate(tests.values())])
            pairs = [
                F.struct(F.lit(rule).alias("rule"), F.col(f"t{i}").alias("n_violations"))
                for i, rule in enumerate(tests)
            ]
            results.append(row.select(F.lit(name).alias("table_name"), F.inline(F.array(*pairs))))

        def total(violations: DataFrame, rule: str, table_name: str = name) -> DataFrame:
            return violations.agg(F.count(F.lit(1)).alias("n_violations")).select(
                F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"), "n_violations"
            )

        if set(table.key) <= have:
            results.append(total(pk_violations(df, table.key), f"key:{'+'.join(table.key)}"))
        for columns in table.unique:
            if set(columns) <= have:
                results.append(total(unique_violations(df, columns), f"unique:{'+'.join(columns)}"))
        for column, (parent, parent_key, _) in table.references.items():
            if column in have and parent in frames:
                orphans = fk_orphans(df, column, frames[parent], parent_key)
                results.append(total(orphans, f"reference:{column}"))
    return union_all(results)
