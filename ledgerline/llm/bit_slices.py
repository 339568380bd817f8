"""Exact top-k search by inner product over a bit-sliced index.

The index holds blocks of rows. In a block, every attribute is quantised and stored as bitmaps,
one a binary digit ("slices"), with a bit for every row of the block. The product of an attribute
with a digit of a query's weight is a slice or nothing, so a query's scores for all rows are the
sum of shifted slices. Bitmaps of equal weight are added three at a time (a full adder keeps one
and carries one), for a block of queries at once. The sum is again a list of slices: going down
from the most significant one, rows that have the digit are above those that have not, until the
k best are known. Rows that agree in all slices at the boundary tie exactly, and those with the
smallest ids are taken.

Blocks of rows and blocks of queries meet by an equality join on the block's number, so memory is
bounded by one block of each. A block sends k rows a query, and a window keeps the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.rows import in_small_batches
from ledgerline.session import materialize, materialize_measured

SCALE = 256
K = 5
# bits of a bitmap, and queries that are added up at a time
BLOCK_ROWS = 4096
BLOCK_QUERIES = 256

INDEX = "n int, dims int, rows binary, ids binary, named binary, values binary, low binary, widths binary, slices binary"
FOUND = "query_row long, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, values) of the vectors whose components are all finite numbers."""
    value = F.col(embedding)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(value, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return (
        vectors.filter(value.isNotNull())
        .filter(F.coalesce(finite, F.lit(False)))
        .select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("values"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Per attribute its least value, its number of digits, and its bitmaps from the lowest digit up."""
    n = len(values)
    words = -(-n // 64)
    low = values.min(0)
    above = values - low
    widths = np.array([int(top).bit_length() for top in above.max(0)], np.int64)
    out = []
    for d, width in enumerate(widths):
        bits = np.zeros((int(width), words * 64), np.uint8)
        bits[:, :n] = (above[:, d] >> np.arange(width)[:, None]) & 1
        out += list(np.packbits(bits, axis=1, bitorder="little").view("<u8"))
    return low, widths, out


def _blocks(sliced: bool):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table["vec_id"].combine_chunks()
        named = np.asarray(ids.is_valid())
        numbers = ids.fill_null(0).to_numpy()
        rows = table["row"].to_numpy()
        # in order of ids, so that the first of tied rows are those to take
        order = np.lexsort([rows, numbers, ~named])
        values = _matrix(table["values"].combine_chunks())[order]
        low, widths, bitmaps = slices_of(values) if sliced else (values[:0], values[:0], [])
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "n": len(order), "dims": values.shape[1], "rows": rows[order].tobytes(),
                    "ids": numbers[order].tobytes(), "named": named[order].tobytes(), "values": values.tobytes(),
                    "low": low.tobytes(), "widths": widths.tobytes(), "slices": b"".join(b.tobytes() for b in bitmaps),
                }
            ],
            schema=_INDEX,
        )

    return build


_INDEX = pa.schema(
    [("n", pa.int32()), ("dims", pa.int32())]
    + [(c, pa.binary()) for c in ("rows", "ids", "named", "values", "low", "widths", "slices")]
)


def _in_blocks(rows: DataFrame, blocks: int, sliced: bool) -> DataFrame:
    """The rows dealt evenly into ``blocks`` blocks, one a task."""
    dealt = in_small_batches(rows).repartition(blocks).mapInArrow(_blocks(sliced), INDEX)
    return materialize(dealt.withColumn("block", F.spark_partition_id()), "blocks")


def _masks(flags: np.ndarray) -> np.ndarray:
    """All ones where a flag is set."""
    return (-flags.astype(np.int64)).view(np.uint64)[:, None]


def summed(queries: np.ndarray, widths: np.ndarray, slices: list[np.ndarray]) -> list[np.ndarray]:
    """Slices of every query's sums over the rows, lowest first.

    A negative weight counts down from the attribute's largest number, which keeps all terms
    positive and shifts the sums of a query by a constant.
    """
    waiting: list[list[np.ndarray]] = []

    def put(bitmap: np.ndarray, at: int) -> None:
        while True:
            while len(waiting) <= at:
                waiting.append([])
            waiting[at].append(bitmap)
            if len(waiting[at]) < 3:
                return
            a, b, c = waiting[at]
            either = a ^ b
            waiting[at] = [either ^ c]
            bitmap, at = (a & b) | (either & c), at + 1

    first = 0
    for d, width in enumerate(widths):
        weights = queries[:, d]
        down = _masks(weights < 0)
        size = np.abs(weights)
        digits = [(b, _masks((size >> b) & 1)) for b in range(int(size.max(initial=0)).bit_length())]
        for j in range(int(width)):
            turned = slices[first + j] ^ down
            for b, digit in digits:
                put(turned & digit, j + b)
        first += int(width)
    at = 0
    while at < len(waiting):
        if len(waiting[at]) == 2:
            a, b = waiting[at]
            waiting[at] = [a ^ b]
            put(a & b, at + 1)
        at += 1
    # a position that no digit reached holds nothing
    nothing = np.zeros((len(queries), len(slices[0]) if slices else 0), np.uint64)
    return [own[0] if own else nothing for own in waiting]


def select_top(sums: list[np.ndarray], open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the highest slice down: rows surely taken, tied rows at the boundary, and how many of these to take."""
    sure = np.zeros_like(open_)
    taken = np.zeros(len(open_), np.int64)
    for bitmap in reversed(sums):
        with_digit = open_ & bitmap
        count = np.bitwise_count(with_digit).sum(1, dtype=np.int64)
        fits = taken + count <= k
        mask = _masks(fits)
        sure |= with_digit & mask
        taken += np.where(fits, count, 0)
        open_ = np.where(fits[:, None], open_ & ~bitmap, with_digit)
    return sure, open_, k - taken


def _bits(bitmaps: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(bitmaps.view(np.uint8), axis=1, count=n, bitorder="little").astype(bool)


def top_of_block(block: dict, queries: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of queries and of their best rows in a block, and the scores."""
    n, words = block["n"], -(-block["n"] // 64)
    dims = max(block["dims"], queries["dims"])
    values, weights = (
        np.pad(np.frombuffer(x["values"], np.int64).reshape(x["n"], x["dims"]), [(0, 0), (0, dims - x["dims"])])
        for x in (block, queries)
    )
    largest = np.abs(values).max(0, initial=0).astype(float) @ np.abs(weights).max(0, initial=0).astype(float)
    if largest >= 2.0**62:
        raise OverflowError("scores do not fit in 64 bits")
    slices = list(np.frombuffer(block["slices"], "<u8").reshape(-1, words))
    # attributes that only the queries have are zero in all rows
    sums = summed(weights, np.frombuffer(block["widths"], np.int64), slices)
    open_ = np.zeros((queries["n"], words * 64), np.uint8)
    open_[:, :n] = 1
    rows, asked = np.frombuffer(block["rows"], np.int64), np.frombuffer(queries["rows"], np.int64)
    _, own, who = np.intersect1d(rows, asked, assume_unique=True, return_indices=True)
    open_[who, own] = 0
    sure, tied, more = select_top(sums, np.packbits(open_, axis=1, bitorder="little").view("<u8"), k)
    tied = _bits(tied, n)
    chosen = _bits(sure, n) | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= more[:, None]))
    who, where = np.nonzero(chosen)
    return who, where, (weights[who] * values[where]).sum(1)


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                pair = batch.slice(at, 1).to_pylist()[0]
                block = {c[2:]: v for c, v in pair.items() if c.startswith("b_")}
                queries = {c[2:]: v for c, v in pair.items() if c.startswith("q_")}
                who, where, scores = top_of_block(block, queries, k)
                ids = np.frombuffer(block["ids"], np.int64)[where]
                unnamed = ~np.frombuffer(block["named"], bool)[where]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(queries["rows"], np.int64)[who]),
                        pa.array(np.frombuffer(queries["ids"], np.int64)[who]),
                        pa.array(ids, mask=unnamed),
                        pa.array(scores, pa.int64()),
                    ],
                    names=["query_row", "query_id", "vec_id", "score"],
                )

    return search


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = K,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for every row of it that ``asks`` (a condition on ``vec_id``) holds for.

    Columns: query_id, rank (from 1), vec_id, score. A component x counts as floor(``scale`` * x);
    the score is the inner product of these integers. Candidates are all rows but the query's own.

    * Vectors that are NULL or hold a NULL, NaN or infinite component take no part. A shorter
      vector counts as filled with zeros, so an empty one scores 0 with all.
    * Equal scores are ranked by smaller vec_id, NULL last. A row without an id is a candidate
      but no query. Rows that share an id are rows of their own, as queries and as candidates.
    * With fewer than ``k`` other rows all of them are returned; an empty table gives no rows.
      Scores that may exceed 62 bits end the job with an error. Other columns are ignored.
    """
    rows = quantised(vectors, vec_id, embedding, scale).withColumn("row", F.monotonically_increasing_id())
    asked = F.coalesce(asks, F.lit(False))
    rows, found = materialize_measured(
        rows.withColumn("asks", asked), "vectors", F.count(F.lit(1)).alias("n"), F.count_if(F.col("asks")).alias("asked")
    )
    blocks = max(1, -(-found["n"] // block_rows))
    index = _in_blocks(rows, blocks, sliced=True)
    queries = _in_blocks(rows.filter("asks"), max(1, -(-found["asked"] // block_queries)), sliced=False)
    parts = ["n", "dims", "rows", "ids", "values"]
    sent = queries.select(
        *[F.col(c).alias(f"q_{c}") for c in parts], F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    ).repartition(blocks, "block")
    kept = index.select(
        "block", *[F.col(c).alias(f"b_{c}") for c in (*parts, "named", "widths", "slices")]
    ).repartition(blocks, "block")
    pairs = kept.join(sent, "block").drop("block")
    best = in_small_batches(pairs).mapInArrow(_searcher(k), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
