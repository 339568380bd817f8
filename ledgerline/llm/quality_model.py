"""A quality classifier on subword embeddings.

Words, pairs of adjacent words and character n-grams are hashed to rows of a matrix of learned
vectors. A document is the average of its vectors, and a softmax layer turns the average into
class probabilities. Vectors and layer are trained together by stochastic gradient descent in
numpy, in one task, on a sample of labelled documents of bounded size.

The layer is linear, so for scoring every row is reduced to its contribution to the log odds. The
reduced table has a fixed size and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.rows import CHECK, KEY, giving_back, in_small_batches, keep_rows, row_key
from ledgerline.session import materialize

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 16
NGRAMS = (2, 3, 4)
# labelled documents to learn from: at most so many, and so many characters of text
SAMPLE_DOCUMENTS = 3000
SAMPLE_CHARS = 64_000_000
EPOCHS = 5
RATE = 2.0
THRESHOLD = 0.7

SALTS = W.mix(np.arange(100, 108, dtype=np.uint64))


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    """The row of every feature, from the top bits of a product."""
    return (((hashes ^ SALTS[kind]) * np.uint64(W.BASE)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(piece: W.Piece) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind of feature: the buckets in the order of the piece, and where each text's begin and end.

    A word that repeats the word before it enters the pair as a mark for repetition, so that
    repeating is one feature whatever the word is.
    """
    words = W.find_words(piece)
    hashes = W.word_hashes(piece, words, lower=False)
    yield _bucket(hashes, 0), words.bounds[:-1], words.bounds[1:]
    left, right = hashes[:-1], hashes[1:]
    pairs = np.where(left == right, SALTS[1], left * np.uint64(W.BASE) + right)
    yield _bucket(W.mix(pairs), 2), *_windows(words.bounds, 2)
    # characters start where a byte is no continuation byte
    starts = np.flatnonzero((piece.bytes & 0xC0) != 0x80)
    bounds = np.searchsorted(starts, piece.bounds)
    n = len(piece.bytes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(W.BYTE_VALUES[piece.bytes] * W.powers(W.BASE, n), out=sums[1:])
    at = np.append(sums[starts], sums[-1])
    shifts = W.powers(W.INVERSE, n)[starts]
    for k, size in enumerate(NGRAMS):
        raw = (at[size:] - at[:-size]) * shifts[: max(0, len(starts) - size + 1)]
        yield _bucket(raw, 3 + k), *_windows(bounds, size)


def _windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows that lie inside each text begin and end."""
    windows = max(0, int(bounds[-1]) - size + 1)
    first = np.minimum(bounds[:-1], windows)
    return first, np.maximum(first, bounds[1:] - size + 1)


def count_buckets(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's features, and their counts in the narrowest type that holds them."""
    rows, counts = np.unique(text, return_counts=True)
    return rows, counts.astype(np.min_scalar_type(counts.max(initial=0)))


def fit(counted: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Train on the counted buckets of every text; the log-odds contribution of every bucket, and the bias."""
    random = np.random.Generator(np.random.PCG64(1))
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, 2))
    bias = np.zeros(2)
    steps, step = EPOCHS * len(counted), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(counted)):
            rate = RATE * (1 - step / steps)
            step += 1
            rows, counts = counted[k]
            shares = (counts.astype(np.float64) / max(1, int(counts.sum())))[:, None]
            mean = (vectors[rows] * shares).sum(0)
            scores = mean @ layer + bias
            odds = np.exp(scores - scores.max())
            error = odds / odds.sum()
            error[labels[k]] -= 1
            # a vector moves by its share of the document, scaled up to the number of its kind
            vectors[rows] -= rate * len(rows) ** 0.5 * shares * (layer @ error)
            layer -= rate * np.outer(mean, error)
            bias -= 0.05 * rate * error
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


@giving_back
def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted, labels, ids = [], [], []
    for batch in batches:
        ids += batch["doc_id"].to_pylist()
        labels += batch["label"].to_pylist()
        for piece in W.pieces(batch["text"]):
            kinds = list(features(piece))
            counted += [
                count_buckets(np.concatenate([buckets[first[k] : last[k]] for buckets, first, last in kinds]))
                for k in range(len(piece))
            ]
    # tasks may read rows in any order; an id occurs once
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    table, bias = fit([counted[k] for k in order], np.array([labels[k] for k in order], int))
    yield pa.RecordBatch.from_arrays(
        [pa.array([table.tobytes()], pa.binary()), pa.array([bias])], names=["weights", "bias"]
    )


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, documents: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS
) -> tuple[np.ndarray, float]:
    """Learn from ``labels`` (doc_id, quality) and the texts of ``docs`` (doc_id, text).

    Held-out rows are never read. Of the others the ids with the smallest hashes are the sample:
    at most ``documents``, with one text each, and at most ``chars`` characters in all, shorter
    texts first. Of an id with several rows the text with the smallest hash is taken. A doc_id
    with several labels counts as bad if one of them is 0; NULL labels and labels other than 0
    and 1 are set aside. Without any label every text gets even odds.
    """
    marked = (
        labels.filter(~held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    # the sample has a fixed number of ids, so it may be broadcast
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    # an id may own very many rows; each task sends one of them at most
    one = found.groupBy("doc_id").agg(
        F.min("label").alias("label"), F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("row")
    )
    sized = one.select("doc_id", "label", "row.text", F.length("row.text").cast("long").alias("size"))
    sized = materialize(sized, "sample")
    # at most ``documents`` rows without their texts
    order = Window.partitionBy(F.lit(0)).orderBy("size", F.xxhash64("doc_id"), "doc_id")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = sized.select("doc_id", upto.alias("upto")).filter(F.col("upto") <= chars)
    sized = sized.join(fits, "doc_id", "left_semi")
    model = sized.select("doc_id", "text", "label").coalesce(1).mapInArrow(_train, "weights binary, bias double")
    fitted = materialize(model, "model").first()
    if fitted is None:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(fitted["weights"], np.float32), fitted["bias"]


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = model.value
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                total, count = np.zeros(len(piece)), np.zeros(len(piece), np.int64)
                for buckets, first, last in features(piece):
                    sums = np.zeros(len(buckets) + 1)
                    np.cumsum(table[buckets], dtype=np.float64, out=sums[1:])
                    total += sums[last] - sums[first]
                    count += last - first
                odds = np.where(count > 0, total / np.maximum(1, count), 0) + bias
                part = batch.slice(piece.first, len(piece))
                scores = pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
                names = ["doc_id", KEY, CHECK]
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], scores], names=[*names, "score"])

    return score


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted and the row's key.

    * The score is the probability of label 1 for the whole text, and depends on nothing else.
      NULL and empty texts have no features and get the probability of the bias.
    * Rows of equal text have equal scores. An empty table gives none. Other columns are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row_key())
    scored = in_small_batches(inputs).mapInArrow(_scorer(shipped), f"doc_id long, {KEY} long, {CHECK} int, score double")
    return scored.withColumn("held_out", held_out()).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted to be good, with all their columns."""
    return keep_rows(docs, score(docs, model, threshold).filter("predicted = 1"))
