"""Document fingerprints from spot signatures.

A signature is a common word (the anchor) with the content words that follow it, up to three or to
the next common word. A text with hardly any also has its pairs of words. A document's signatures
form its fingerprint; documents are compared by the Jaccard similarity of their fingerprints.

In a search, fingerprints are partitioned by size, and only those of partitions next to each other
that share one of their rarest signatures meet. Those that meet in one place are first compared
with the one of them that meets most others; only what stays in different groups is compared with
further ones, a few more each round.

Everything is a DataFrame function. Texts are shuffled once, into slices of neighbouring ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.components import components
from ledgerline.session import materialize, materialize_measured

# common words of English, French, German and Spanish
ANCHORS = (
    "the a an of and to in is that it for was on as with be by this are from or at "
    "le la les un une des de du et en que qui est dans pour pas sur au avec par "
    "der die das den dem ein eine und von zu mit für auf im nicht sich auch "
    "el los las del y se con no su lo"
).split()
CHAIN = 3
SIMILARITY = 0.8
# a text with fewer signatures than this has its pairs of words as well
FEW = 3
# neighbouring documents meet in slices of about so many rows; there are at most so many slices
SLICE_ROWS = 2000
MOST_SLICES = 1 << 16
# ids that are looked at per slice to find where it begins
ROWS_PER_CUT = 16
# where a slice is looked up in two steps, so many beginnings a step
STEP = 256
# signatures are counted in so many bins, to tell frequent ones from rare ones
BINS = 1 << 16
# documents that all others of a place are compared with in one round, at most
HUBS = 64


def _pattern(anchors: Sequence[str], chain: int) -> str:
    words = "|".join(sorted(set(anchors)))
    return f"(?<= )(?:{words})(?: (?!(?:{words}) )[^ ]++){{1,{chain}}}(?= )"


def signatures(text: Column, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """The distinct signatures of a whole text as sorted 32-bit hashes.

    Words are runs of letters and digits in lower case. A text with fewer than FEW signatures also
    has all its pairs of adjacent words, or its only word. A text without words, an empty one too,
    has the hash of the text itself as its only one, so that different texts differ.
    """
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # a text that begins or ends with other characters has two blanks there, which ends no word
    found = F.regexp_extract_all(plain, F.lit(_pattern(anchors, chain)), F.lit(0))
    hashes = F.transform(found, lambda s: F.hash(s))
    words = F.split(F.trim(plain), " +")
    n = F.size(words) - 1
    # the words are split once a side, not once a pair
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.hash(F.lit("pair"), a, b))
    few = (
        F.when(F.trim(plain) == "", F.array(F.hash(F.lit("text"), text)))
        .when(F.size(words) == 1, F.array(F.hash(F.lit("word"), F.element_at(words, 1))))
        .otherwise(F.concat(hashes, pairs))
    )
    return F.array_sort(F.array_distinct(F.when(F.size(found) >= FEW, hashes).otherwise(few)))


def fingerprint(signs: Column) -> Column:
    """The signatures as one string: eight hexadecimal digits each, in order."""
    return F.array_join(F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays of signatures."""
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def _in_slices(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__slice``, a number in order of ``__key``; slices have about SLICE_ROWS rows.

    Where slices begin is read off a sorted sample of the keys, so uneven ids make even slices.
    """
    n = rows.count()
    slices = max(1, min(MOST_SLICES, n // SLICE_ROWS))
    wanted = slices * ROWS_PER_CUT
    sample = rows.select("__key") if wanted >= n else rows.sample(wanted / n, seed=3).select("__key")
    keys = F.sort_array(F.collect_list("__key"))
    # every so many keys a slice begins; the first slice begins with the first row
    cuts = f"filter(keys, (k, i) -> i > 0 AND i % greatest(1, size(keys) div {slices}) = 0)"
    found = sample.agg(keys.alias("keys")).select(F.expr(cuts).alias("cuts"))
    coarse = F.expr(f"filter(cuts, (k, i) -> i % {STEP} = 0)")
    bounds = found.select(F.struct(coarse.alias("coarse"), "cuts")).scalar()

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda cut: cut <= F.col("__key")))

    # columns, since functions on arrays take no subqueries
    known = rows.withColumn("__coarse", bounds["coarse"]).withColumn("__cuts", bounds["cuts"])
    first = F.greatest(upto(F.col("__coarse")) - 1, F.lit(0)) * STEP
    number = first + upto(F.slice(F.col("__cuts"), first + 1, F.lit(STEP)))
    return known.withColumn("__slice", number.cast("int")).drop("__coarse", "__cuts")


def with_next(docs: DataFrame, id_: str = "doc_id", text: str = "text", *extra: Column) -> DataFrame:
    """``id_``, ``text`` and ``extra`` of every row, and the same of the row after it as struct ``next``.

    Rows are ordered by id, NULL last, and a hash of the text; the first row follows the last. The
    order is cut into slices of about equal size. The first row of a slice is added to the end of
    the slice before it, so every row meets the next one within its slice. Extra columns are
    computed after the one shuffle of the texts.
    """
    rows = docs.select(F.col(id_).cast("long").alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn(
        "__key", F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.xxhash64("__text").alias("hash"))
    )
    sliced = _in_slices(rows)
    # one key per slice, so their number is bounded
    heads = materialize(sliced.groupBy("__slice").agg(F.min("__key").alias("__head")), "slice-heads")
    around = Window.partitionBy(F.lit(0)).orderBy("__slice")
    before = F.coalesce(F.lag("__slice").over(around), F.max("__slice").over(Window.partitionBy(F.lit(0))))
    heads = heads.select(F.col("__slice").alias("__at"), "__head", before.alias("__before"))
    first = (
        sliced.join(F.broadcast(heads), (F.col("__slice") == F.col("__at")) & F.col("__key").eqNullSafe(F.col("__head")))
        .groupBy("__before")
        .agg(F.min(F.struct("__key", "__id", "__text")).alias("first"))
        .select("first.__id", "first.__text", "first.__key", F.col("__before").alias("__slice"), F.lit(1).alias("__extra"))
    )
    placed = sliced.withColumn("__extra", F.lit(0)).unionByName(first).repartition("__slice")
    kept = placed.select("__slice", "__extra", "__key", F.col("__id").alias(id_), F.col("__text").alias(text), *extra)
    fields = [c for c in kept.columns if c not in ("__slice", "__extra", "__key")]
    order = Window.partitionBy("__slice").orderBy("__extra", "__key", text)
    following = F.struct(*[F.lead(c).over(order).alias(c) for c in fields]).alias("next")
    return kept.select("__extra", *fields, following).filter("__extra = 0").drop("__extra")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, signatures and fingerprint of every row of ``docs`` (doc_id, text); NULL text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text")).select(
        "doc_id", "text", signatures(F.col("text")).alias("signatures")
    ).withColumn("fingerprint", fingerprint(F.col("signatures")))


def _class_of(signs: Column) -> Column:
    """128 bits that name a set of signatures."""
    halves = [F.xxhash64(signs), F.xxhash64(F.lit(1), signs)]
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """How the fingerprint of every text holds against an edit, and against the next text.

    The edited text has the last quarter of the text (rounded down, in code points) replaced by
    the first as many of the next document, or by all it has.

    * NULL and empty texts are edited by nothing and are like themselves.
    * Rows of equal id are ordered by a hash of their text; repeated rows follow one another.
    * A single row follows itself. An empty table gives no rows. Other columns are ignored.
    """
    rows = with_next(docs, "doc_id", "text", signatures(F.col("__text")).alias("signs"))
    size = F.char_length("text")
    changed = F.floor(size / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - changed), F.substring(F.col("next.text"), F.lit(1), changed)
    )
    compared = rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "signs",
        edited.alias("edited"),
        likeness(F.col("signs"), F.col("next.signs")).alias("near_next"),
    )
    compared = compared.withColumn("edited_signs", signatures(F.col("edited")))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("signs")).alias("fingerprint"),
        fingerprint(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        "near_next",
        F.size("signs").cast("long").alias("n_signatures"),
    )


def _rare_signatures(classes: DataFrame, threshold: float) -> DataFrame:
    """(place, cls, n): the places in which a class of n signatures meets those it may be like.

    A set of n signatures can only be alike to one that has one of its n - ceil(threshold * n) + 1
    first in any one order of all signatures. Here rare ones are first: those in bins that hold no
    more than twice the mean. A set goes to its own partition of sizes and to the next.
    """
    bin_ = F.pmod("sign", F.lit(BINS))
    counts = classes.select(F.explode("signs").alias("sign")).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # at most as many rows as bins; a bit tells that a bin is full
    mean = F.sum("n").over(Window.partitionBy(F.lit(0))) / F.lit(float(BINS))
    full = counts.withColumn("mean", mean).filter(F.col("n") > 2 * F.greatest(F.col("mean"), F.lit(1.0)))
    words = full.groupBy((F.col("bin") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bin % 64 AS INT))")).alias("bits")
    )
    table = materialize(words, "full-bins").agg(F.collect_list(F.struct("word", "bits")).alias("w"))
    every = F.expr(f"transform(sequence(0, {BINS // 64 - 1}), k -> element_at(map_from_entries(w), k))")
    bits = materialize(table.select(every.alias("bits")), "bin-bits").select("bits").scalar()
    classes = classes.withColumn("bits", bits)

    def order(sign: Column) -> Column:
        at = F.pmod(sign, F.lit(BINS))
        word = F.coalesce(F.get(F.col("bits"), F.shiftright(at, 6)), F.lit(0).cast("long"))
        return F.struct(F.getbit(word, at.bitwiseAND(F.lit(63))).alias("full"), F.hash(F.lit(7), sign).alias("mixed"), sign.alias("sign"))

    n = F.size("signs")
    prefix = (n - F.ceil(threshold * n - 1e-9) + 1).cast("int")
    part = F.floor(F.log(n.cast("double")) / -F.log(F.lit(threshold)) + 1e-9).cast("int")
    first = F.slice(F.array_sort(F.transform("signs", order)), F.lit(1), prefix)
    rows = classes.select("cls", n.alias("n"), part.alias("part"), F.explode(first).alias("s"))
    rows = rows.select("cls", "n", F.col("s.sign").alias("sign"), F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    return rows.select(F.xxhash64("sign", "part").alias("place"), "cls", "n")


def _links(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that are alike."""
    near = F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9
    wanted = pairs.filter(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return (
        wanted.join(classes.select(F.col("cls").alias("a"), F.col("signs").alias("sa")), "a")
        .join(classes.select(F.col("cls").alias("b"), F.col("signs").alias("sb")), "b")
        .filter(likeness(F.col("sa"), F.col("sb")) >= threshold - 1e-12)
        .select("a", "b")
    )


def groups(prints: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(cls, group_id) of every class of ``prints`` (doc_id, cls, signs).

    Equal fingerprints are one class from the start. In every place that classes share, all are
    compared with a hub, the class that shares most places. Hubs and their likes are connected; in
    places whose classes are still in different groups the next hubs follow, twice as many each
    round. What was compared as a hub leaves its place, so rounds end when all that meet are
    connected or compared.
    """
    classes = prints.groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("signs").alias("signs"))
    classes = materialize(classes, "print-classes")
    rare = materialize(_rare_signatures(classes, threshold), "rare-signatures")
    crowded = rare.groupBy("place").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialize(rare.join(crowded, "place"), "shared-places")
    weights = shared.groupBy("cls").agg(F.sum("size").alias("weight"))
    members = materialize(shared.drop("size").join(weights, "cls"), "place-members")
    links = None
    labels = prints.sparkSession.createDataFrame([], "node binary, label binary")
    hubs = 1
    while not members.isEmpty():
        best = Window.partitionBy("place").orderBy(F.desc("weight"), "cls")
        ranked = members.withColumn("turn", F.row_number().over(best)).filter(F.col("turn") <= hubs)
        chosen = materialize(ranked.select("place", F.col("cls").alias("b"), F.col("n").alias("nb")), "hubs")
        met = members.select("place", F.col("cls").alias("a"), F.col("n").alias("na")).join(chosen, "place").filter("a != b")
        found, counted = materialize_measured(_links(met, classes, threshold), "print-links", F.count(F.lit(1)).alias("n"))
        if counted["n"]:
            links = found if links is None else links.unionByName(found)
            labels = materialize(components(links), "print-labels")
        rest = members.join(chosen.select("place", F.col("b").alias("cls")), ["place", "cls"], "left_anti")
        labelled = rest.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        labelled = materialize(labelled, "open-members")
        mixed = labelled.groupBy("place").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter("l1 != l2")
        members = materialize(labelled.drop("label").join(mixed.select("place"), "place", "left_semi"), "place-members")
        hubs = min(HUBS, 2 * hubs)
    named = classes.select("cls", "least").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("label", F.coalesce("label", "cls"))
    least = named.groupBy("label").agg(F.min("least").alias("group_id"))
    return named.join(least, "label").select("cls", "group_id")


def similar(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, fingerprint, group_id): documents in groups connected by a likeness of ``threshold`` or more.

    ``group_id`` is the smallest doc_id of the group; a group without any id has NULL.
    """
    prints = fingerprints(docs).select("doc_id", _class_of(F.col("signatures")).alias("cls"), F.col("signatures").alias("signs"))
    prints = materialize(prints, "prints")
    found = prints.join(groups(prints, threshold), "cls")
    return found.select("doc_id", fingerprint(F.col("signs")).alias("fingerprint"), "group_id")
