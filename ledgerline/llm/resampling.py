"""Importance resampling: draw the documents whose words look most like those of a target.

Words are hashed into a fixed number of buckets. A bucket's gain is the log of how much likelier
it is in the target than in the corpus, and a document weighs the sum of its words' gains. Adding
Gumbel noise to the weights and taking the highest scores draws without replacement in proportion
to the weights' exponentials.

Texts are read once: the bucket numbers of every document are stored, two bytes a feature, counted
by tasks into arrays, and looked up in the broadcast array of gains, which has one entry a bucket
however large the corpus is. The cutoff among the scores is bracketed by a quantile sketch. Exact
counts outside the bracket show whether the cutoff is inside; if not, the bracket is widened. Only
its rows are sorted to find the cutoff, and the rows above it to be ranked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.rows import CHECK, KEY, in_small_batches, keep_rows, row_key
from ledgerline.operators.ordered import number_rows
from ledgerline.session import materialize

BUCKETS = 10_000
# features are runs of 1 to LONGEST consecutive words
LONGEST = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# relative rank error of the sketch is 1 / ACCURACY
ACCURACY = 1000

ROW = "__row"
# words are made of digits, letters a to z and all that is not ASCII
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# longer features leave the byte-by-byte loop over all features
_LONG = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """zlib's crc32 of every span, all spans one byte further at a time."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    begin, size = starts[order], sizes[order]
    out = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long = int(np.searchsorted(-size, -_LONG, "left"))
    # spans from `long` on have at most _LONG bytes, in descending order of size
    for k in range(int(size[long]) if long < len(size) else 0):
        to = int(np.searchsorted(-size, -k, "left"))
        own = out[long:to]
        out[long:to] = _CRC[(own ^ data[begin[long:to] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for k in range(long):
        out[k] = zlib.crc32(data[begin[k] : begin[k] + size[k]])
    found = np.empty_like(out)
    found[order] = out
    return found


def _joined(piece: W.Piece, words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' lower-case bytes with one blank after each, and where every word begins and ends."""
    sizes = words.ends - words.starts
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    data = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(starts, sizes) + inside] = _LOWER[piece.bytes[np.repeat(words.starts, sizes) + inside]]
    return data, starts, ends


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _featurizer(buckets: int, longest: int):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                words = W.find_words(piece, _BETWEEN)
                data, starts, ends = _joined(piece, words)
                texts = words.texts()
                owners, found = [], []
                for size in range(1, longest + 1):
                    first = np.flatnonzero(W.within(words.bounds, size)) if len(starts) >= size else np.zeros(0, int)
                    owners.append(texts[first])
                    found.append(_crc32(data, starts[first], ends[first + size - 1]) % np.uint32(buckets))
                owner, bucket = np.concatenate(owners), np.concatenate(found)
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(len(piece) + 1))
                flat = bucket[order].astype(_width(buckets))
                part = batch.slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part[c] for c in ("doc_id", KEY, CHECK)],
                        pa.array(np.diff(words.bounds), pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                    ],
                    names=["doc_id", KEY, CHECK, "n_words", "n_features", "buckets"],
                )

    return features


def features(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """The numbers of the buckets of all features of every text, as little-endian integers."""
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row_key())
    schema = f"doc_id long, {KEY} long, {CHECK} int, n_words long, n_features long, buckets binary"
    return in_small_batches(inputs).mapInArrow(_featurizer(buckets, longest), schema)


def _numbers(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a batch, and the bounds of its documents."""
    sizes = np.array([len(v) for v in column.to_pylist()], np.int64) // int(width[-1])
    return np.frombuffer(b"".join(column.to_pylist()), width), np.concatenate([[0], np.cumsum(sizes)])


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all documents; a task sends at most one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            totals += np.bincount(_numbers(batch["buckets"], _width(buckets))[0], minlength=buckets)
        filled = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(totals[filled])], names=["bucket", "n"])

    counts = found.select("buckets").mapInArrow(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(found: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, for featurized corpus and target."""
    spark = found.sparkSession
    counted = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(bucket_counts(found, buckets).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target, buckets).withColumnRenamed("n", "t"), "bucket", "left")
        .fillna(0)
    )
    # one row a bucket, a fixed number
    rows = np.array(counted.select("bucket", "s", "t").collect(), np.int64)
    rows = rows[np.argsort(rows[:, 0])]
    s, t = rows[:, 1].astype(float), rows[:, 2].astype(float)
    odds = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(odds)).astype(np.int64)


def _weigher(table, buckets: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bounds = _numbers(batch["buckets"], _width(buckets))
            sums = np.concatenate([[0], np.cumsum(table.value[numbers])])
            weights = pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64())
            kept = ["doc_id", KEY, CHECK, "n_words", "n_features"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], weights], names=[*kept, "weight"])

    return weigh


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A standard Gumbel number of the id, times 1000, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED
) -> DataFrame:
    """One stored row per row of ``docs`` (doc_id, text): n_words, n_features, weight and score."""
    ids = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    found = materialize(features(docs, buckets, longest), "features")
    wanted = materialize(features(ids, buckets, longest), "target-features")
    table = docs.sparkSession.sparkContext.broadcast(gains(found, wanted, buckets))
    schema = f"doc_id long, {KEY} long, {CHECK} int, n_words long, n_features long, weight long"
    weighed = in_small_batches(found).mapInArrow(_weigher(table, buckets), schema)
    scored = weighed.withColumn("score", F.col("weight") + noise(seed=seed))
    # a number for every row tells copies of a row apart once it is stored
    return materialize(scored.withColumn(ROW, F.monotonically_increasing_id()), "scores")


def bracket(scores: DataFrame, wanted: int, of: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Scores (low, high) between which the ``wanted``-th highest of ``of`` lies, and how many are above.

    A sketch proposes brackets of growing width, exact counts outside them decide.
    """
    share = 1 - wanted / of
    error = 2 / accuracy
    widths = []
    while error < 1:
        widths.append((max(0.0, share - error), min(1.0, share + error)))
        error *= 8
    widths.append((0.0, 1.0))
    points = [p for pair in widths for p in pair]
    sketch = scores.agg(
        F.percentile_approx("score", points, accuracy), F.min("score"), F.max("score")
    ).first()
    ends = [*sketch[0][:-2], sketch[1], sketch[2]]
    for low, high in zip(ends[::2], ends[1::2]):
        above, below = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") < low)).first()
        if above <= wanted <= of - below:
            return low, high, above
    raise AssertionError("the widest bracket holds all scores")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col(ROW).asc()]


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (see :func:`weigh`) with ``rank``, which is NULL for rows that are not drawn."""
    enough = F.col("n_words") >= min_words
    of = scored.filter(enough).count()
    wanted = percent * of // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", none)
    long = scored.filter(enough)
    low, high, above = bracket(long, wanted, of)
    top = number_rows(long.filter(F.col("score") > high), _order(), "rank", unique_rows=True)
    inside = number_rows(
        long.filter(F.col("score").between(low, high)), _order(), "rank", start=above + 1, unique_rows=True
    )
    inside = inside.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(~enough | (F.col("score") < low)).select("*", none)
    return top.unionByName(inside).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its weight, score and rank, drawn towards ``target`` (text).

    Of the N documents with at least ``min_words`` words the floor(percent * N / 100) highest
    scores are drawn; they have ranks 1, 2, 3 and so on, all others NULL.

    * Whole texts are read. NULL and empty texts have no features, weight 0 and are never drawn.
    * A document's noise depends on its id alone; a NULL id reads as an empty string. Equal scores
      are ranked by smaller doc_id, NULL last, and equal rows in any order.
    * Repeated rows count, weigh and are drawn each on its own. Empty tables give no rows; an empty
      target leaves gains that only make frequent words cheaper. Other columns are ignored.
    """
    return draw(weigh(docs, target, buckets, longest, seed), percent, min_words)


def keep_drawn(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents, with all their columns; copies of a drawn row stay with it."""
    drawn = resample(docs, target, **settings).filter("rank IS NOT NULL")
    return keep_rows(docs, drawn.select(KEY, CHECK))
