"""Surrogate keys, dimension extraction and text-to-key resolution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import number_rows
from ledgerline.session import materialize


def one_per_key(
    df: DataFrame, key: Sequence[str], attributes: Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """One row per key, with the attributes of a single winning row.

    The row with the largest ``newest`` values wins, then the one with the
    largest attributes. ``max`` of a struct is a partial aggregate, so a key
    with many rows is reduced before the shuffle.
    """
    ranked = [*newest, *[a for a in attributes if a not in newest]]
    if not ranked:
        return df.select(*key).distinct()
    winner = df.groupBy(*key).agg(F.max(F.struct(*ranked)).alias("__winner"))
    return winner.select(*key, *[F.col("__winner")[a].alias(a) for a in attributes])


def extract_dimension(
    df: DataFrame,
    id_column: str,
    key: Sequence[str],
    attributes: Sequence[str] = (),
    newest: Sequence[str] = (),
) -> DataFrame:
    """Distinct keys of ``df`` with their attributes, numbered in key order.

    Rows are made distinct before they are numbered. Rows with a NULL key name
    no entity and are left out. Conflicting attributes are settled by
    :func:`one_per_key`; :func:`ledgerline.operators.quality.fd_violations`
    lists the conflicts.
    """
    named = df
    for k in key:
        named = named.filter(F.col(k).isNotNull())
    rows = one_per_key(named, key, attributes, newest)
    return number_rows(rows, order=list(key), out=id_column, unique_rows=True)


def next_ids(
    existing: DataFrame,
    incoming: DataFrame,
    id_column: str,
    order: Sequence[str],
    unique_rows: bool = False,
) -> DataFrame:
    """Give ``incoming`` rows the ids that follow the largest existing one."""
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("last")).scalar()
    numbered = number_rows(incoming, order, "__n", unique_rows=unique_rows)
    return numbered.select((last + F.col("__n")).cast("bigint").alias(id_column), *incoming.columns)


@dataclass(frozen=True)
class Resolved:
    """Result of :func:`resolve_keys`."""

    rows: DataFrame
    dimension: DataFrame
    unresolved: DataFrame


def resolve_keys(
    facts: DataFrame,
    dimension: DataFrame,
    text: str,
    name: str,
    id_column: str,
    on_missing: str = "stub",
) -> Resolved:
    """Replace the text column of ``facts`` by the key of ``dimension``.

    A name that occurs twice in the dimension resolves to its smallest id, so
    facts never fan out. Names the dimension lacks are reported with their row
    count and then handled by ``on_missing``:

    ``stub``        add a dimension row with a new id (other columns NULL)
    ``quarantine``  keep them out of ``rows``; ``unresolved`` holds the facts
    ``drop``        keep them out of ``rows``

    Facts whose text is NULL keep a NULL key.
    """
    if on_missing not in ("stub", "quarantine", "drop"):
        raise ValueError(f"unknown policy: {on_missing}")
    ids = dimension.groupBy(F.col(name).alias(text)).agg(F.min(id_column).alias(id_column))
    # distinct texts first: the check never joins the full facts
    texts = facts.filter(F.col(text).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = materialize(texts.join(ids, text, "left_anti"), "missing")
    columns = [id_column, *[c for c in facts.columns if c != text]]
    named = facts.filter(F.col(text).isNotNull())
    blank = facts.filter(F.col(text).isNull()).withColumn(
        id_column, F.lit(None).cast(dimension.schema[id_column].dataType)
    )
    if on_missing == "stub" and not missing.isEmpty():
        names = missing.select(F.col(text).alias(name))
        stubs = materialize(next_ids(dimension, names, id_column, [name], unique_rows=True), "stubs")
        dimension = dimension.unionByName(stubs, allowMissingColumns=True)
        ids = ids.unionByName(stubs.select(F.col(name).alias(text), id_column))
    found = named.join(ids, text)
    unresolved = (
        named.join(ids, text, "left_anti") if on_missing == "quarantine" else missing
    )
    return Resolved(
        rows=found.select(*columns).unionByName(blank.select(*columns)),
        dimension=dimension,
        unresolved=unresolved,
    )


def left_join_named(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join in which facts with a NULL key skip the shuffle.

    A NULL key matches nothing, yet a plain left join sends all of them to one
    task. They are padded and added back instead.
    """
    extra = [f for f in dimension.schema.fields if f.name != key]
    columns = [*facts.columns, *[f.name for f in extra]]
    named = facts.filter(F.col(key).isNotNull()).join(dimension, key, "left")
    blank = facts.filter(F.col(key).isNull())
    for f in extra:
        blank = blank.withColumn(f.name, F.lit(None).cast(f.dataType))
    return named.select(*columns).unionByName(blank.select(*columns))
