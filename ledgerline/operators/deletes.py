"""Deletes that follow what the references declare: refuse, or take the children along."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerline.model import TABLES, Shop
from ledgerline.operators.changes import apply_stock, line_deletes, stock_deltas
from ledgerline.operators.quality import cascade_deletes, cascade_survivors, restrict_blockers

SIDES = {"transaction_items": "sale", "restock_items": "restock"}
# blocked keys named in an error
SHOWN = 5


class DeleteBlocked(ValueError):
    """Rows that may not go refer to rows that were to be deleted."""


@dataclass(frozen=True)
class Deletion:
    """The shop that is left, the rows that went, by table, and the stock movements that follow."""

    shop: Shop
    gone: dict[str, DataFrame]
    deltas: DataFrame | None


def _children(table: str):
    for name, child in TABLES.items():
        for column, (parent, parent_key, action) in child.references.items():
            if parent == table:
                yield name, column, parent_key, action


def _collect(shop: Shop, table: str, rows: DataFrame, gone: dict[str, DataFrame]) -> None:
    gone[table] = rows
    for child, column, parent_key, action in _children(table):
        lines = getattr(shop, child)
        if action == "restrict":
            blocked = restrict_blockers(rows, parent_key, lines, column)
            first = blocked.orderBy("key_value").limit(SHOWN).collect()
            if first:
                shown = ", ".join(f"{r.key_value} ({r.n_rows} rows)" for r in first)
                raise DeleteBlocked(f"{table}: {child}.{column} still refers to {shown}")
        else:
            taken = cascade_deletes(lines, column, rows, parent_key).select(*lines.columns)
            _collect(shop, child, taken, gone)


def delete_rows(shop: Shop, table: str, keys: DataFrame) -> Deletion:
    """Delete the rows of ``table`` whose key is in ``keys`` (one column, named as the key).

    References that restrict are checked first; if rows refer to what is to go,
    :class:`DeleteBlocked` is raised and nothing changes. References that cascade take their
    rows along. Deleted lines move the stored stock back. Keys that are not there do nothing.
    """
    key = TABLES[table].key[0]
    rows = getattr(shop, table)
    chosen = keys.select(key).distinct()
    gone: dict[str, DataFrame] = {}
    _collect(shop, table, rows.join(chosen, key, "left_semi"), gone)
    left = {table: rows.join(chosen, key, "left_anti")}
    for child, column, parent_key, action in _children(table):
        if action == "cascade":
            lines = getattr(shop, child)
            left[child] = cascade_survivors(lines, column, gone[table], parent_key).select(*lines.columns)
    deltas = None
    for name, side in SIDES.items():
        if name in gone:
            moved = stock_deltas(line_deletes(gone[name], side))
            deltas = moved if deltas is None else deltas.unionByName(moved)
    if deltas is not None and "products" not in left:
        left["products"] = apply_stock(shop.products, deltas)
    return Deletion(shop.replace(**left), gone, deltas)
