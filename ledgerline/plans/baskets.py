"""Association rules over sets of items, counted on bitmaps.

Baskets are numbered, and every item has a bitmap over ranges of basket numbers: which baskets of
the range hold it. A set's baskets are the intersection of its items' bitmaps, so a basket costs
a bit per item, however many items it holds. Sets grow level by level: a candidate of k items is
tried only if all its subsets of k - 1 are frequent. Candidates go to all ranges, ranges send back
how often each occurs, and only the counts of candidates reach the driver, whose number the least
support bounds: a basket of m frequent items supports at most C(m, k) sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import Shop
from ledgerline.operators.ordered import number_rows
from ledgerline.session import materialize

MAX_ITEMS = 4
# candidates that travel to the tasks at once
CANDIDATES_AT_ONCE = 50_000


def basket_items(shop: Shop, item: str) -> DataFrame:
    """(transaction_id, item): the distinct items of every sale, named by a column of products."""
    names = shop.products.select("product_id", F.col(item).cast("string").alias("item"))
    lines = shop.transaction_items.select("transaction_id", "product_id").distinct()
    return lines.join(names, "product_id").select("transaction_id", "item").distinct()


def _ranges(bought: DataFrame, items: DataFrame) -> DataFrame:
    """One row per range of baskets: range, item numbers and their bitmaps."""
    baskets = number_rows(bought.select("transaction_id").distinct(), ["transaction_id"], "basket", start=1, unique_rows=True)
    placed = bought.join(items.select("item", "number"), "item").join(baskets, "transaction_id")
    maps = placed.groupBy(F.bitmap_bucket_number("basket").alias("range"), "number").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("basket")).alias("bits")
    )
    # at most a bitmap of 4 KB per frequent item
    return maps.groupBy("range").agg(F.collect_list(F.struct("number", "bits")).alias("maps"))


def _counter(candidates: np.ndarray):
    """Counts of the candidates (rows of item numbers, in lexicographic order) in every range."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for maps in batch["maps"].to_pylist():
                bits = {m["number"]: np.frombuffer(m["bits"], np.uint64) for m in maps}
                shared: list[np.ndarray | None] = [None] * candidates.shape[1]
                last = None
                for at, row in enumerate(candidates):
                    # sets that begin alike share the intersection of their beginning
                    k = 0 if last is None else int(np.argmax(row != last))
                    for j in range(k, len(row)):
                        own, before = bits.get(int(row[j])), shared[j - 1] if j else None
                        shared[j] = own if j == 0 else None if own is None or before is None else own & before
                    last = row
                    if shared[-1] is not None:
                        totals[at] += int(np.bitwise_count(shared[-1]).sum())
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(totals[found])], names=["at", "n"])

    return count


def _grown(sets: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Sets of one item more all of whose subsets are among ``sets``, in lexicographic order."""
    known = set(sets)
    groups: dict[tuple[int, ...], list[int]] = {}
    for s in sets:
        groups.setdefault(s[:-1], []).append(s[-1])
    out = []
    for head, tails in groups.items():
        for a, b in combinations(sorted(tails), 2):
            grown = (*head, a, b)
            if all(grown[:k] + grown[k + 1 :] in known for k in range(len(grown) - 2)):
                out.append(grown)
    return sorted(out)


def frequent_sets(bought: DataFrame, least: int, max_items: int = MAX_ITEMS) -> tuple[dict[tuple[str, ...], int], DataFrame]:
    """Sets of up to ``max_items`` items in at least ``least`` baskets with their counts; and the numbered items.

    ``bought`` has one row per basket and item: transaction_id, item.
    """
    singles = bought.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    items = materialize(number_rows(singles, ["item"], "number", unique_rows=True), "frequent-items")
    # each is in `least` baskets at least, which bounds their number
    names = {r["number"]: (r["item"], r["n"]) for r in items.collect()}
    found = {(k,): n for k, (_, n) in names.items()}
    ranges = materialize(_ranges(bought, items), "basket-ranges")
    level = sorted(found)
    for _ in range(2, max_items + 1):
        candidates = _grown(level)
        level = []
        for first in range(0, len(candidates), CANDIDATES_AT_ONCE):
            own = np.array(candidates[first : first + CANDIDATES_AT_ONCE], np.int64)
            counts = ranges.select("maps").mapInArrow(_counter(own), "at long, n long")
            counts = counts.groupBy("at").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
            for r in counts.collect():
                s = tuple(int(k) for k in own[r["at"]])
                found[s] = r["n"]
                level.append(s)
        level.sort()
        if len(level) < 2:
            break
    return {tuple(names[k][0] for k in s): n for s, n in found.items()}, items


def basket_rules(
    shop: Shop, item: str, min_support: float, min_confidence: float = 0.0, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Rules "who buys these items also buys that one" from sets of two to ``max_items`` items.

    Columns: items (the left side, joined by " + "), also, n_items, n_both (baskets with all of
    them), confidence, lift. A set must be in ``min_support`` of all baskets. Only closed sets give
    rules: a set that a larger frequent set contains in just as many baskets says nothing new.
    """
    spark = shop.products.sparkSession
    bought = materialize(basket_items(shop, item), "bought")
    baskets = bought.select("transaction_id").distinct().count()
    least = max(1, math.ceil(min_support * baskets))
    sets, _ = frequent_sets(bought, least, max_items)
    open_ = {
        tuple(x for x in s if x != out) for s, n in sets.items() for out in s if sets.get(tuple(x for x in s if x != out)) == n
    }
    rows = []
    for s, n in sets.items():
        if len(s) < 2 or s in open_:
            continue
        for also in s:
            left = tuple(x for x in s if x != also)
            confidence = n / sets[left]
            if confidence >= min_confidence:
                lift = n * baskets / (sets[left] * sets[(also,)])
                rows.append((" + ".join(left), also, len(s), n, confidence, lift))
    schema = "items string, also string, n_items int, n_both bigint, confidence double, lift double"
    return spark.createDataFrame(rows, schema).select(
        "items", "also", "n_items", "n_both", *[F.round(c, 6).alias(c) for c in ("confidence", "lift")]
    )
