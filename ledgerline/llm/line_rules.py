"""Quality rules: base counts of every text and the frequency of lines across documents.

Lines that many documents of a host repeat are taken for boilerplate. A document passes if it
passes the base rules and enough of it is left once such lines are taken out.

A family of edited copies repeats its lines as boilerplate does, and all its members would be
rejected. What tells it from pages around a menu is that the lines are in no document that passes,
and are nearly all of the documents that have them. Of such documents the first that has a line
is kept, so no line of the family is lost.

The counts of a text come from numpy inside tasks, one pass over whole texts. Lines meet in two
partial aggregations, first per line and document, then per line, so a line that every document
has costs a task no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.rows import CHECK, KEY, in_small_batches, keep_rows, row_key
from ledgerline.session import materialize

MIN_WORDS = 10
# percent of the words that may lie in repeated windows
MAX_REPEATED = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
# A line is boilerplate if more documents of its host have it than both limits say.
MIN_DOCUMENTS = 20
HOST_PERCENT = 2
# percent of a document's words that must be left without boilerplate lines
MIN_LEFT = 30
# percent of a document's lines that no kept document has, from which on it may stand for them
MIN_LOST = 75

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = (
    "doc_id long, source string, row_key long, row_check int, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", lines array<long>, line_words array<int>, body long"
)


def _repeated_words(words: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a window which the text holds at least twice."""
    texts = words.texts()
    n = len(words.bounds) - 1
    windows = W.window_hashes(hashes, WINDOW)
    inside = np.flatnonzero(W.within(words.bounds, WINDOW)) if len(windows) else np.zeros(0, int)
    keys = W.mix(windows[inside] + (texts[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(W.BASE))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 1, np.int64)
    at = inside[twice]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return W.per_owner(texts[np.cumsum(covered[:-1]) > 0], n)


def _lines(piece: W.Piece, words: W.Words) -> tuple[np.ndarray, ...]:
    """Byte spans of the lines with a word, their texts and the positions of their words."""
    breaks = np.flatnonzero(piece.bytes == W.NEWLINE)
    starts = np.unique(np.concatenate([piece.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(piece.bytes)]
    # a line ends at the next break or with its text
    texts = np.searchsorted(piece.bounds, starts, "right") - 1
    ends = np.append(breaks, len(piece.bytes))[np.searchsorted(breaks, starts, "left")]
    ends = np.minimum(ends, piece.bounds[texts + 1])
    first = np.searchsorted(words.starts, starts)
    last = np.searchsorted(words.starts, ends)
    filled = last > first
    return starts[filled], ends[filled], first[filled], last[filled], texts[filled]


def _duplicates(keys: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Per text, how many of its keys equal an earlier one."""
    own = W.mix(keys + (texts.astype(np.uint64) + np.uint64(1)) * np.uint64(W.BASE))
    _, first = np.unique(own, return_index=True)
    return W.per_owner(texts, n) - W.per_owner(texts[first], n)


def _bodies(lines: list[np.ndarray]) -> np.ndarray:
    """A hash of the distinct lines of every text, in order; only texts that agree in all of them share it."""
    bounds = np.concatenate([[0], np.cumsum([len(own) for own in lines])]).astype(np.int64)
    flat = np.concatenate(lines) if lines else np.zeros(0, np.int64)
    return W.span_hashes(flat.view(np.uint64), bounds[:-1], bounds[1:]).view(np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in W.pieces(batch["text"]):
            n = len(piece)
            part = batch.slice(piece.first, n)
            words = W.find_words(piece)
            exact = W.word_hashes(piece, words, lower=False)
            # no space byte is part of a character, so words hold all other first bytes
            chars = ((piece.bytes & 0xC0) != 0x80) & ~W.SPACE[piece.bytes]
            starts, ends, first, last, texts = _lines(piece, words)
            raw = W.span_hashes(W.BYTE_VALUES[piece.bytes], starts, ends)
            counts = {
                "n_words": np.diff(words.bounds),
                "word_chars": piece.per_text(chars),
                "n_symbols": piece.per_text(_SYMBOL[piece.bytes]),
                "n_dup_lines": _duplicates(raw, texts, n),
                "n_repeat_words": _repeated_words(words, exact),
            }
            folded = W.word_hashes(piece, words, lower=True)
            normal = W.span_hashes(folded, first, last).view(np.int64)
            sizes = (last - first).astype(np.int32)
            bounds = np.searchsorted(texts, np.arange(n + 1))
            lines, line_words = [], []
            for k in range(n):
                own = normal[bounds[k] : bounds[k + 1]]
                distinct, back = np.unique(own, return_inverse=True)
                lines.append(distinct)
                # the words of all copies of a line
                line_words.append(np.bincount(back, sizes[bounds[k] : bounds[k + 1]], len(distinct)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part[c] for c in ("doc_id", "source", KEY, CHECK)],
                    *[pa.array(counts[c], pa.int64()) for c in COUNTS],
                    _nested(lines, pa.int64()),
                    _nested(line_words, pa.int32()),
                    pa.array(_bodies(lines), pa.int64()),
                ],
                names=["doc_id", "source", "row_key", "row_check", *COUNTS, "lines", "line_words", "body"],
            )


def _nested(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    bounds = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=bounds[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, kind))


def measure(docs: DataFrame) -> DataFrame:
    """The base counts and the distinct normalised lines of every text."""
    inputs = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"), *row_key()
    )
    return in_small_batches(inputs).mapInArrow(_measure, SCHEMA)


def frequent_lines(
    measured: DataFrame, min_documents: int = MIN_DOCUMENTS, host_percent: float = HOST_PERCENT
) -> DataFrame:
    """Lines (source, line) that more of a host's distinct documents have than the limits allow."""
    one_host = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    seen = (
        measured.select(one_host.alias("host"), F.explode("lines").alias("line"), "body")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("documents"))
        .filter(F.col("documents") > min_documents)
    )
    distinct = measured.select(one_host.alias("host"), "body").distinct()
    hosts = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    return seen.join(hosts, "host").filter(F.col("documents") * 100 > F.col("host_documents") * host_percent)


def judge(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    host_percent: float = HOST_PERCENT,
    min_left: int = MIN_LEFT,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): counts, verdicts and the row's key.

    * Words, lines and windows are taken from the whole text. NULL and empty texts have no words
      and fail the base rules.
    * Lines are compared without regard to the case of A to Z and to white space. A line counts
      once per document however often it is repeated there; documents that agree in all their
      distinct lines are copies and count once, among a line's documents and among the host's.
    * The host is ``source``; NULL is a host of its own.
    * A document that boilerplate lines deplete is kept after all if at least ``MIN_LOST`` percent
      of its distinct lines are in no document that passes, and it is the first (by doc_id, NULL
      last, then by a hash of id and text) such document to have one of them.
    * Repeated rows get a row each, with equal verdicts. Ties do not arise. An empty table gives
      none. Other columns of ``docs`` are ignored.
    """
    measured = materialize(measure(docs).withColumn("__row", F.monotonically_increasing_id()), "lines")
    frequent = frequent_lines(measured, min_documents, host_percent).select("host", "line")
    host = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    hits = materialize(
        measured.select("__row", host.alias("host"), F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
        .select("__row", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
        .join(frequent, ["host", "line"]),
        "boilerplate",
    )
    lost = hits.groupBy("__row").agg(F.sum("words").alias("boilerplate_words"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("boilerplate_words")
    judged = (
        measured.withColumn("n_lines", F.size("lines"))
        .drop("lines", "line_words", "body")
        .join(lost, "__row", "left")
        .withColumn("boilerplate_words", F.coalesce("boilerplate_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (100 * left >= min_left * F.col("n_words")))
    )
    judged = materialize(judged, "judged")
    standing = _standing_for_lines(judged, hits).withColumn("__stands", F.lit(True))
    kept = F.col("kept") | F.coalesce("__stands", F.lit(False))
    return (
        judged.join(standing, ["row_key", "row_check"], "left")
        .withColumn("kept", kept)
        .select(*[c for c in judged.columns if c not in ("__row", "n_lines")])
    )


def _standing_for_lines(judged: DataFrame, hits: DataFrame) -> DataFrame:
    """(row_key, row_check) of depleted documents that are the first to hold a line that would be lost."""
    passed = hits.join(judged.filter("kept").select("__row"), "__row", "left_semi").select("host", "line").distinct()
    gone = hits.select("__row", "host", "line").join(passed, ["host", "line"], "left_anti")
    depleted = judged.filter("NOT kept AND NOT base_failed").select("__row", "doc_id", "row_key", "row_check", "n_lines")
    counts = gone.groupBy("__row").agg(F.count(F.lit(1)).alias("n_gone"))
    alike = depleted.join(counts, "__row").filter(F.col("n_gone") * 100 >= F.col("n_lines") * MIN_LOST)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "row_check")).alias("first")
    holders = gone.join(alike, "__row").groupBy("host", "line").agg(first)
    return holders.select("first.row_key", "first.row_check").distinct()


def keep_good(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents that pass, with all their columns."""
    passed = judge(docs, **limits).filter("kept")
    return keep_rows(docs, passed.select(F.col("row_key").alias(KEY), F.col("row_check").alias(CHECK)))
