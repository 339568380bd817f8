"""Byte-level BPE encoding and decoding by a file of ranked byte strings.

Every match of the pattern is a word of its own. A word is an array of byte strings, and a fold
merges the adjacent pair of the lowest rank until no pair has one. Decoding concatenates the byte
strings of the ids.

:func:`encode_words` folds arrays of distinct words by Spark's higher-order functions over a literal
rank map, an array of small maps in which a string's hash finds its map. On whole corpora that
takes several times the CPU time that a corpus may cost (figures in the README). So
:func:`encode` folds the distinct words of a task in Python, with the rank map broadcast.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import giving_back, in_small_batches

# a task remembers the ids of at most so many words, then forgets them all
MOST_KNOWN = 1 << 18
# words up to this length are folded by scanning a list
SHORT = 64
MAPS = 1 << 16
NO_RANK = (1 << 31) - 1
IDS = np.dtype("<u4")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 byte string and its rank on every line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@functools.cache
def _literal(path: str) -> tuple[str, int]:
    """The rank map as JSON: an array of maps from hexadecimal byte strings to ranks."""
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for token, rank in read_ranks(path).items():
        maps[_place(token.hex())][token.hex()] = rank
    return json.dumps(maps, separators=(",", ":")), MAPS


def _place(key: str) -> int:
    return zlib.crc32(key.encode()) % MAPS


def _rank(table: Column, token: Column) -> Column:
    small = F.get(table, (F.crc32(token.cast("binary")) % MAPS).cast("int"))
    return F.coalesce(F.element_at(small, token), F.lit(NO_RANK))


def fold_word(word: Column, table: Column) -> Column:
    """The ids of one word, by merging the adjacent pair of the lowest rank as often as there is one."""
    none = F.array().cast("array<int>")

    def start(parts: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(parts) - 2),
            lambda i: _rank(table, F.concat(F.get(parts, i), F.get(parts, i + 1))),
        )
        return F.struct(parts.alias("parts"), F.when(F.size(parts) > 1, pairs).otherwise(none).alias("ranks"))

    def merge(state: Column, at: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]
        merged = F.concat(F.get(parts, at - 1), F.get(parts, at))
        before = F.concat(
            F.slice(ranks, F.lit(1), at - 2), F.array(_rank(table, F.concat(F.get(parts, at - 2), merged)))
        )
        after = F.concat(
            F.array(_rank(table, F.concat(merged, F.get(parts, at + 1)))), F.slice(ranks, at + 2, F.size(ranks))
        )
        return F.struct(
            F.concat(
                F.slice(parts, F.lit(1), at - 1), F.array(merged), F.slice(parts, at + 2, F.size(parts))
            ).alias("parts"),
            F.concat(
                F.when(at > 1, before).otherwise(none), F.when(at < F.size(ranks), after).otherwise(none)
            ).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        least = F.coalesce(F.array_min(state["ranks"]), F.lit(NO_RANK))
        at = F.array_position(state["ranks"], least).cast("int")
        return F.when(least < NO_RANK, F.get(F.transform(F.array(at), lambda p: merge(state, p)), 0)).otherwise(state)

    code = F.lower(F.hex(F.encode(word, "UTF-8")))
    parts = F.regexp_extract_all(code, F.lit(".."), F.lit(0))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(word) - 1))
    return F.aggregate(steps, start(parts), step, lambda s: F.transform(s["parts"], lambda p: _rank(table, p)))


def encode_words(words: Column, path: str) -> Column:
    """The ids of every word of an array of words."""
    table = F.from_json(F.lit(_literal(path)[0]), "array<map<string,int>>")
    # the literal is bound once, as a variable of an outer function
    return F.flatten(
        F.transform(F.array(table), lambda t: F.transform(words, lambda w: fold_word(w, t)))
    )


def fold_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word, as :func:`fold_word` finds them."""
    if word in ranks:
        return [ranks[word]]
    return _fold_short(word, ranks) if len(word) <= SHORT else _fold_long(word, ranks)


def _fold_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Looks for the leftmost pair of the lowest rank in a list, which is short."""
    rank = ranks.get
    parts = [word[k : k + 1] for k in range(len(word))]
    pairs = [rank(word[k : k + 2], NO_RANK) for k in range(len(word) - 1)]
    while pairs:
        least = min(pairs)
        if least == NO_RANK:
            break
        at = pairs.index(least)
        merged = parts[at] = parts[at] + parts.pop(at + 1)
        pairs.pop(at)
        if at < len(pairs):
            pairs[at] = rank(merged + parts[at + 1], NO_RANK)
        if at:
            pairs[at - 1] = rank(parts[at - 1] + merged, NO_RANK)
    return [ranks[part] for part in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Takes the pairs from a heap, so time grows with the length and its logarithm only."""
    n = len(word)
    ends = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank = ranks.get
    pairs = [(r, k, k + 2) for k in range(n - 1) if (r := rank(word[k : k + 2])) is not None]
    heapq.heapify(pairs)
    while pairs:
        _, first, end = heapq.heappop(pairs)
        middle = ends[first]
        # a pair is stale once one of its parts has been merged
        if middle >= end or middle == 0 or ends[middle] != end:
            continue
        ends[first], ends[middle] = end, 0
        if end < n:
            before[end] = first
            after = ends[end]
            if (r := rank(word[first:after])) is not None:
                heapq.heappush(pairs, (r, first, after))
        left = before[first]
        if left >= 0 and (r := rank(word[left:end])) is not None:
            heapq.heappush(pairs, (r, left, end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return ids


class Known(dict):
    """The ids, as bytes, of the distinct words that a task has met; a new word is folded once."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = np.array(fold_bytes(word.encode(), self.ranks), IDS).tobytes()
        return ids


def _encoder(ranks, pattern: str, names: list[str]) -> Callable:
    def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        known = Known(ranks.value)
        for batch in batches:
            ids = []
            for text in batch["text"].to_pylist():
                ids.append(b"".join(map(known.__getitem__, split(text or ""))))
                if len(known) > MOST_KNOWN:
                    known.clear()
            columns = [batch[n] for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names=[*names, "ids"])

    return giving_back(encode_texts)


def _inputs(docs: DataFrame, keys: list[str]) -> tuple[DataFrame, str]:
    """The columns ``keys`` and text of ``docs``, in small batches, and the schema of the keys."""
    inputs = docs.select(*[F.col(f"`{k}`") for k in keys], F.col("text").cast("string").alias("text"))
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema if f.name != "text")
    return in_small_batches(inputs), plain


def encode(docs: DataFrame, path: str, pattern: str, keys: list[str]) -> DataFrame:
    """The columns ``keys`` of ``docs`` and ids: the ids of the whole text as little-endian 32-bit integers.

    NULL and empty texts have no ids. Special tokens are ordinary text. Every row gives one row;
    an empty table gives none. Other columns than ``keys`` and text are ignored.
    """
    inputs, plain = _inputs(docs, keys)
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    return inputs.mapInArrow(_encoder(shipped, pattern, keys), f"{plain}, ids binary")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, keys: list[str]) -> DataFrame:
    """What :func:`decode` makes of what :func:`encode` returns, in one Python worker per task.

    Two operators in a row would keep two workers, each with its copy of the ranks.
    """
    inputs, plain = _inputs(docs, keys)
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    encoder, decoder = _encoder(shipped, pattern, keys), _decoder(shipped)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoder(encoder(batches))

    return inputs.mapInArrow(both, f"{plain}, ids binary, bytes binary")


def _pieces(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks.items()}


def _decoder(ranks) -> Callable:
    def decode_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _pieces(ranks.value).__getitem__
        for batch in batches:
            texts = [b"".join(map(piece, np.frombuffer(ids or b"", IDS).tolist())) for ids in batch["ids"].to_pylist()]
            names = [*batch.schema.names, "bytes"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=names)

    return giving_back(decode_ids)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (with ids) and bytes: the concatenated byte strings of the ids."""
    shipped = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoder(shipped), f"{fields}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes, per row of ``docs``.

    ``with_ids`` adds the ids themselves as token_ids, little-endian 32-bit integers.
    """
    coded = encode_and_decode(docs, path, pattern, ["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        *([F.col("ids").alias("token_ids")] if with_ids else []),
    )
