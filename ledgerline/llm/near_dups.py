"""Near duplicates by SetSketch registers.

A register is the smallest of exponentially distributed hash values over a document's shingles,
rounded up on an exponential scale and truncated to 16 bits. Registers of a union are the larger
ones of both, so sketches can be merged. Equal sets of shingles are one class from the start.
Classes that share a band of registers are candidates. The likelihood of the registers decides
whether a similarity at the threshold can be ruled out; all other candidates are compared on
their full sets.

In a bucket every class is first compared with the smallest one only, which takes a bucket of
copies at linear cost. Classes of a bucket that this leaves in different components are then
compared with each other, so no link is lost to the shortcut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.operators.components import components
from ledgerline.llm.rows import CHECK, KEY, in_small_batches, keep_rows, row_key
from ledgerline.session import materialize

# 32 bands of 4 registers: at similarity 0.8 a pair shares no band with probability 5e-8
BAND = 4
BANDS = 32
REGISTERS = BAND * BANDS
SCALE = 1.001
RATE = 20.0
LAST = (1 << 16) - 1
# a pair is ruled out if the threshold is this many times exp() less likely than the best fit
REFUTED = 20.0
GRID = 64
# a block of a bucket has at most so many classes, and shingles
BLOCK_ROWS = 2048
BLOCK_VALUES = 1 << 22

_random = np.random.Generator(np.random.PCG64(9))
MULTIPLIERS = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SALTS = W.mix(np.arange(1, BANDS + 1, dtype=np.uint64))

SALTS = W.mix(np.array([71, 72], np.uint64))

SKETCH = "doc_id long, key long, check int, n_shingles long, cls binary, registers binary"


def shingle_sets(piece: W.Piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted within the text, and the texts' bounds.

    A text of fewer words than a shingle has its whole sequence as the only one.
    """
    words = W.find_words(piece)
    hashes = W.word_hashes(piece, words, lower=True)
    texts = words.texts()
    windows = W.window_hashes(hashes, size)
    inside = np.flatnonzero(W.within(words.bounds, size)) if len(windows) else np.zeros(0, np.int64)
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = W.mix(
        W.span_hashes(hashes, words.bounds[short], words.bounds[short + 1]) + np.uint64(size)
    )
    owners = np.concatenate([texts[inside], short])
    shingles = np.concatenate([windows[inside], whole])
    order = np.lexsort((shingles, owners))
    owners, shingles = owners[order], shingles[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (shingles[1:] != shingles[:-1])
    owners, shingles = owners[new], shingles[new]
    return shingles, np.searchsorted(owners, np.arange(len(piece) + 1))


def registers_of(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers of non-empty sets that begin at ``starts``; a row per set."""
    least = np.empty((len(starts), REGISTERS), np.uint64)
    for k in range(REGISTERS):
        least[:, k] = np.minimum.reduceat(shingles * MULTIPLIERS[k], starts)
    uniform = (least.astype(np.float64) + 1.0) / 2.0**64
    values = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(values) / np.log(SCALE)), 0, LAST).astype("<u2")


def _fixed(values: np.ndarray) -> pa.Array:
    """Rows of a contiguous array as binary values of equal length."""
    n, width = len(values), values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    raw = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, raw]).cast(pa.binary())


def _class_ids(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits per set that do not depend on the order of its members."""
    out = np.empty((len(starts), 2), np.uint64)
    for k in range(2):
        out[:, k] = W.mix(np.add.reduceat(W.mix(shingles + SALTS[k]), starts))
    return out


def _sketcher(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                part = batch.slice(piece.first, len(piece))
                shingles, bounds = shingle_sets(piece, size)
                n = np.diff(bounds)
                filled = np.flatnonzero(n)
                at = np.full(len(piece), -1)
                at[filled] = np.arange(len(filled))
                index = pa.array(at, mask=at < 0)
                if len(filled):
                    starts = bounds[filled]
                    classes = _fixed(_class_ids(shingles, starts)).take(index)
                    registers = _fixed(registers_of(shingles, starts)).take(index)
                else:
                    classes = registers = pa.nulls(len(piece), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["key"], part["check"], pa.array(n, pa.int64()), classes, registers],
                    names=["doc_id", "key", "check", "n_shingles", "cls", "registers"],
                )

    return sketch


def _setter(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                shingles, bounds = shingle_sets(piece, size)
                part = batch.slice(piece.first, len(piece))
                members = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(shingles.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([part["cls"], members], names=["cls", "members"])

    return sets


def band_keys(registers: np.ndarray) -> np.ndarray:
    bands = np.ascontiguousarray(registers).view("<u8")
    return W.mix(W.mix(bands) + BAND_SALTS).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        registers = np.frombuffer(b"".join(batch["registers"].to_pylist()), "<u2").reshape(-1, REGISTERS)
        keys = band_keys(registers)
        index = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1)), batch["cls"].take(index)], names=["band", "cls"]
        )


def _step(x: np.ndarray) -> np.ndarray:
    """Probability that a register is larger, for a difference ``x`` of relative sizes."""
    return -np.log1p(-x * (SCALE - 1) / SCALE) / np.log(SCALE)


def refuted(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, threshold: float):
    """Whether the registers rule out a similarity of at least ``threshold``.

    The numbers of larger, smaller and equal registers have a joint likelihood that depends on
    the sizes, which are known, and the similarity alone. Its best value over a grid of all
    similarities is compared with the best at the threshold or above.
    """
    larger = (left > right).sum(1)[:, None]
    smaller = (left < right).sum(1)[:, None]
    equal = left.shape[1] - larger - smaller
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    # both parts of the grid: below the threshold and from it on
    low = np.minimum(threshold, most) * np.linspace(0, 1, GRID)[None, :]
    high = threshold + np.maximum(most - threshold, 0) * np.linspace(0, 1, GRID)[None, :]

    def best(similarity: np.ndarray) -> np.ndarray:
        up = np.maximum(_step(np.maximum(u - v * similarity, 0)), 1e-9)
        down = np.maximum(_step(np.maximum(v - u * similarity, 0)), 1e-9)
        same = np.maximum(1 - up - down, 1e-9)
        return (larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)).max(1)

    high_best = best(high)
    return (most[:, 0] < threshold - 1e-9) | (high_best < np.maximum(best(low), high_best) - REFUTED)


def _filterer(threshold: float):
    def unrefuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch[c].to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb")
            )
            na, nb = (batch[c].to_numpy(zero_copy_only=False).astype(np.float64) for c in ("na", "nb"))
            keep = pa.array(~refuted(left, right, na, nb, threshold))
            yield batch.select(["a", "b"]).filter(keep)

    return unrefuted


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
    bounds, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[bounds[k] : bounds[k + 1]] for k in range(len(column)))


def _confirmer(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(_lists(batch["ma"]), _lists(batch["mb"]), strict=True):
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return linked


class Linker:
    """Confirms candidate pairs of classes; holds the sketches and sets they need."""

    def __init__(self, sketches: DataFrame, sets: DataFrame, percent: int):
        self.sketches, self.sets, self.percent = sketches, sets, percent

    def __call__(self, pairs: DataFrame) -> DataFrame:
        def side(name: str, table: DataFrame, **columns: str) -> DataFrame:
            return table.select(F.col("cls").alias(name), *[F.col(c).alias(n) for n, c in columns.items()])

        near = (
            pairs.join(side("a", self.sketches, na="n_shingles", ra="registers"), "a")
            .join(side("b", self.sketches, nb="n_shingles", rb="registers"), "b")
            # the smaller set of a linked pair has at least that share of the larger
            .filter(
                (100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
            )
            .mapInArrow(_filterer(self.percent / 100), "a binary, b binary")
        )
        near = materialize(near, "near-pairs")
        return (
            near.join(side("a", self.sets, ma="members"), "a")
            .join(side("b", self.sets, mb="members"), "b")
            .mapInArrow(_confirmer(self.percent), "a binary, b binary")
        )


def _comparer(percent: int):
    def links_of(rows: pa.Table) -> list[tuple[bytes, bytes]]:
        """Links between the rows of one place."""
        registers = np.frombuffer(b"".join(rows["registers"].to_pylist()), "<u2").reshape(-1, REGISTERS)
        bands = band_keys(registers)
        band = rows["band"][0].as_py()
        classes, labels = rows["cls"].to_pylist(), np.array(rows["label"].to_pylist(), object)
        n, c = (rows[k].to_numpy().astype(np.float64) for k in ("n", "c"))
        second, same = (rows[k].to_numpy().astype(bool) for k in ("second", "same"))
        members = list(_lists(rows["members"]))
        order = np.array(classes, object)
        found = []
        for x in range(len(classes)):
            if second[x]:
                continue
            # a block meets itself in ascending order, and another block as a whole
            wanted = (order > classes[x]) & same if same[x] else second
            wanted = wanted & (labels != labels[x])
            wanted &= (100 + percent) * np.minimum(c, c[x]) >= percent * (n + n[x])
            y = np.flatnonzero(wanted)
            shared = bands[y] == bands[x]
            # a pair is compared in the first band it shares
            y = y[bands[x][shared.argmax(1)] == band] if len(y) else y
            if not len(y):
                continue
            left = np.broadcast_to(registers[x], (len(y), REGISTERS))
            y = y[~refuted(left, registers[y], np.full(len(y), n[x]), n[y], percent / 100)]
            for k in y:
                both = len(np.intersect1d(members[x], members[k], assume_unique=True))
                if 100 * both >= percent * (len(members[x]) + len(members[k]) - both):
                    found.append((classes[x], classes[k]))
        return found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: pa.Table) -> pa.RecordBatch:
            places = rows["place"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1, [len(places)]])
            found = [
                link for first, last in zip(cuts[:-1], cuts[1:], strict=True) if last - first > 1
                for link in links_of(rows.slice(first, last - first))
            ]
            sides = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(s, pa.binary()) for s in sides], names=["a", "b"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            places = rows["place"].to_numpy()
            # the last place may go on in the next batch
            cut = int(np.searchsorted(places, places[-1], "left"))
            if cut:
                yield out(rows.slice(0, cut))
            rest = rows.slice(cut).combine_chunks()
        if rest is not None:
            yield out(rest)

    return compare


def _mixed(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold classes of more than one component."""
    labels = members.groupBy("band").agg(F.min("label").alias("l1"), F.max("label").alias("l2"))
    return members.join(labels.filter("l1 != l2").select("band"), "band", "left_semi")


def _crossing(
    members: DataFrame, labels: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) between classes of a bucket that the hubs left in different components.

    Shingles that no other class at hand has cannot be in an intersection. So if c of the n
    shingles of a class are shared, a link to a class of m shingles needs
    (100 + percent) * c >= percent * (n + m). Edited copies that missed a link to the bucket's
    smallest class mostly fail this for every size the bucket holds, and leave before pairs are made.
    """
    known = labels.withColumnRenamed("node", "cls")
    labelled = members.join(known, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    # the hub has been compared with all of its bucket
    open_ = materialize(_mixed(labelled).filter("cls != hub").select("band", "cls", "label"), "open")
    at_hand = sets.join(open_.select("cls").distinct(), "cls", "left_semi")
    unique = (
        at_hand.select(F.xxhash64("cls").alias("who"), F.explode("members").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"), F.min("who").alias("who"))
        .filter("n = 1")
        .groupBy("who")
        .agg(F.count(F.lit(1)).alias("unique"))
    )
    sizes = (
        sketches.select("cls", "n_shingles", F.xxhash64("cls").alias("who"))
        .join(unique, "who", "left")
        .select("cls", F.col("n_shingles").alias("n"), (F.col("n_shingles") - F.coalesce("unique", F.lit(0))).alias("c"))
    )
    sized = materialize(open_.join(sizes, "cls"), "sized")
    least = sized.groupBy("band").agg(F.min("n").alias("least"))
    possible = sized.join(least, "band").filter((100 + percent) * F.col("c") >= percent * (F.col("n") + F.col("least")))
    possible = materialize(_mixed(possible.drop("least")), "possible")
    return _compare_blocks(possible, sketches, sets, percent)


def _compare_blocks(possible: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one bucket that have different labels.

    A bucket is cut into blocks whose sets fill a bounded number of bytes, and every pair of
    blocks is compared in one place. Only links leave the tasks.
    """
    sizes = possible.groupBy("band").agg(
        F.ceil(F.count(F.lit(1)) / F.greatest(F.lit(2), F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK_VALUES / F.max("n")))))
        .cast("int")
        .alias("blocks")
    )
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    placed = (
        possible.join(sizes, "band")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
            "band", "cls", "label", "n", "c", (F.col("own") > F.col("other")).alias("second"),
            (F.col("own") == F.col("other")).alias("same"),
        )
    )
    return (
        placed.join(sketches.select("cls", "registers"), "cls")
        .join(sets, "cls")
        .repartition("place")
        .sortWithinPartitions("place")
        .mapInArrow(_comparer(percent), "a binary, b binary")
    )


def _distinct_pairs(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the group it belongs to.

    Columns: doc_id, key and check (see ``rows.row_key``), n_shingles, component_id, kept, chosen.
    Documents are linked if 100 * |intersection| >= ``percent`` * |union| of their sets of
    ``size``-word shingles; ``component_id`` is the smallest doc_id reachable over links.

    * Words are split at white space, A to Z are read as a to z. A text with fewer words than a
      shingle has its whole sequence as its one shingle.
    * A text that is NULL or has no words has no shingles and is linked with nothing; its
      component is its own doc_id.
    * Rows with equal sets are linked. Rows may share a doc_id; the smallest non-NULL doc_id of a
      component names it, and ``kept`` is true for the rows that bear it (all NULL: NULL is the
      name and the rows are kept). ``chosen`` is true for one document of a component only, the
      first by doc_id (NULL last), key and check, and its repetitions, and for every text without
      shingles.
    * An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    inputs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[c.alias(n) for c, n in zip(row_key(), ("key", "check"), strict=True)],
    )
    rows = materialize(in_small_batches(inputs).mapInArrow(_sketcher(size), SKETCH), "sketches")
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("rep"),
        F.min(F.struct("key", "check")).alias("row"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "check")).alias("first"),
        F.max("n_shingles").alias("n_shingles"),
        F.max("registers").alias("registers"),
    )
    classes = materialize(classes, "classes")
    bands = classes.select("cls", "registers").mapInArrow(_bands, "band long, cls binary")
    bands = materialize(bands, "bands")
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(bands.join(buckets, "band"), "shared")
    # the class that shares the most is likely the original the others were copied from
    weights = shared.groupBy("cls").agg(F.sum("n").alias("weight"))
    weighted = shared.drop("n").join(weights, "cls")
    hubs = weighted.groupBy("band").agg(F.max(F.struct("weight", "cls"))["cls"].alias("hub"))
    members = materialize(weighted.join(hubs, "band"), "members")

    candidates = members.select("cls").distinct()
    sketches = materialize(classes.join(candidates, "cls", "left_semi"), "candidates")
    wanted = sketches.select("cls", "row.key", "row.check")
    texts = inputs.join(wanted, ["key", "check"]).dropDuplicates(["cls"]).select("cls", "text")
    sets = materialize(texts.mapInArrow(_setter(size), "cls binary, members array<long>"), "sets")
    confirm = Linker(sketches, sets, percent)

    stars = members.filter("cls != hub").select(*_distinct_pairs(F.col("cls"), F.col("hub"))).distinct()
    links = materialize(confirm(stars), "links")
    labels = materialize(components(links), "labels")

    more = materialize(_crossing(members, labels, sketches, sets, percent), "more-links")
    labels = components(links.unionByName(more))

    owners = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "rep", "first", F.coalesce("label", "cls").alias("label")
    )
    owners = materialize(owners, "owners")
    names = owners.groupBy("label").agg(F.min("rep").alias("component_id"), F.min("first").alias("first"))
    named = owners.drop("first").join(names, "label").select(
        "cls", "component_id", F.struct("first.key", "first.check").alias("first")
    )
    alone = F.col("cls").isNull()
    return (
        rows.drop("registers")
        .join(named, "cls", "left")
        .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumn("chosen", alone | (F.struct("key", "check") == F.col("first")))
        .select("doc_id", "key", "check", "n_shingles", "component_id", "kept", "chosen")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of every group, with all its columns; rows of equal id and text count as one document."""
    chosen = groups(docs, size, percent).filter("chosen")
    return keep_rows(docs, chosen.select(F.col("key").alias(KEY), F.col("check").alias(CHECK)), one_of_copies=True)
