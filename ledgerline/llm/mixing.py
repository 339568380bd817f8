"""Mixing sources to target weights by Pareto order sampling.

Every document gets a desired number of copies from its source's target. The whole part is taken
for certain. The rest is an inclusion probability; documents are ranked by random odds over
inclusion odds, and the first ones are taken until their words fill what the source still needs.
The odds differ within a source: a preference, by default the square root of a document's words,
makes some documents likelier than others. The random number comes from the doc_id, the text and
a number among equal rows, so reruns agree and rows that share an id are drawn each on its own.

What the corpus decides is one row per source: the level of copies and the last document taken.
It is found from sums and a histogram of ranks, so no source is sorted in one task, and documents
meet it in a join on the source without being shuffled themselves while the sources are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.rows import text_of
from ledgerline.operators.ordered import number_rows
from ledgerline.operators.reshape import expand_rows
from ledgerline.session import materialize, materialize_measured

WORD = r"[^\x20\x09-\x0D]+"
# by position of the source in code point order, repeating
WEIGHTS = (5, 2, 1)
# all targets together, as a multiple of all sizes
TOTAL = 1.5
# a source's target stops at this multiple of its size, a document's copies at this number
MOST = 2
# ranks are counted in so many steps per source
STEPS = 1 << 16
# preferences are rounded to this many steps per doubling, and held between 2^-8 and 2^8
PREFERENCE_STEPS = 16
# prefer documents by the square root of their words; one of so many words has preference 1
BY_WORDS = "words"
USUAL_WORDS = 256


def random_odds() -> Column:
    """u / (1 - u) for a number u between 0 and 1 that depends on the id, the text and the number among equal rows."""
    name = F.concat_ws(":", F.coalesce(F.col("__id").cast("string"), F.lit("null")), "__text", F.col("__copy").cast("string"))
    digits = F.substring(F.md5(name.cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return u / (1 - u)


def _level(
    rows: DataFrame, key: list[str], need: Column, mass: Column, weight: Column, rate: Column, out: str
) -> DataFrame:
    """Per ``key``, the level at which the sum of least(MOST, level * weight) * mass is ``need``.

    ``rate`` is weight * mass. ``rows`` has few rows per key. With the rows in the order in which they reach MOST, the level
    is the largest of what remains for the others once the earlier ones are full.
    """
    order = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    order = order.orderBy(F.desc("__weight"))
    full = F.sum(MOST * F.col("__mass")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    slope = F.sum("__rate").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = rows.select(
        *key, need.alias("__need"), mass.cast("double").alias("__mass"), weight.cast("double").alias("__weight"),
        rate.cast("double").alias("__rate"),
    ).select(*key, F.try_divide(F.col("__need") - F.coalesce(full, F.lit(0.0)), slope).alias("__level"))
    return levels.groupBy(*key).agg(F.greatest(F.max("__level"), F.lit(0.0)).alias(out))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL) -> DataFrame:
    """(source, source_size, target) for every source of ``sizes`` (source, size).

    Sources in code point order, NULL last, weigh ``weights`` in turn and share ``total`` times all
    sizes; a target stops at MOST times its source, and the excess is shared by weight among the
    rest. One row per source is handled in one task.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(position - 1, F.lit(len(weights))) + 1)
    )
    everything = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    weighed = weighed.withColumn("need", total * everything)
    # copies per word of a source grow with its weight over its size
    per_word = F.when(F.col("source_size") > 0, F.col("weight") / F.col("source_size"))
    filled = weighed.filter("source_size > 0")
    level = _level(filled, [], F.col("need"), F.col("source_size"), per_word, F.col("weight"), "level")
    # one number
    found = level.first()
    reached = F.lit(float(found["level"]) if found else 0.0) * F.col("weight")
    target = F.least((MOST * F.col("source_size")).cast("double"), reached)
    return weighed.select("source", "source_size", target.alias("target"))


def _preference(column: str | None) -> Column:
    if column is None:
        return F.lit(1.0)
    if column == BY_WORDS:
        worth = F.sqrt(F.col("size") / F.lit(float(USUAL_WORDS)))
    else:
        worth = F.col(f"__doc.`{column}`").cast("double")
    steps = F.round(F.log2(worth) * PREFERENCE_STEPS)
    steps = F.greatest(F.lit(-8.0 * PREFERENCE_STEPS), F.least(F.lit(8.0 * PREFERENCE_STEPS), steps))
    return F.coalesce(F.pow(F.lit(2.0), steps / PREFERENCE_STEPS), F.lit(1.0))


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds the desired copies, the certain ones and the rank among the uncertain."""
    rows = rows.withColumn("__copies", F.coalesce(F.least(F.lit(float(MOST)), F.col("level") * F.col("__pref")), F.lit(0.0)))
    rows = rows.withColumn("__whole", F.floor("__copies"))
    part = F.col("__copies") - F.col("__whole")
    odds = F.when(part > 0, random_odds() / (part / (1 - part)))
    # ties go by the id
    return rows.withColumn("__rank", F.when(odds.isNotNull(), F.struct(odds.alias("odds"), F.col("__id").alias("id"))))


def _same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("__source"))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL) -> DataFrame:
    """One row per source: __source, source_size, target, level, last (rank of the last one taken).

    ``sizes`` has __id, __text, __copy, source, size and __pref and is read several times.
    """
    goals = targets(sizes, weights, total)
    classes = sizes.groupBy("source", "__pref").agg(F.sum("size").alias("mass")).filter("mass > 0")
    classes = classes.join(
        goals.select(F.col("source").alias("__source"), "target"), _same_source()
    ).select("source", "__pref", "mass", "target")
    level = _level(
        classes.withColumn("__null", F.col("source").isNull()), ["source", "__null"], F.col("target"), F.col("mass"),
        F.col("__pref"), F.col("mass") * F.col("__pref"), "level",
    ).select(F.col("source").alias("__level_source"), "level")
    goals = goals.join(level, F.col("source").eqNullSafe(F.col("__level_source")), "left").select(
        F.col("source").alias("__source"), "source_size", "target", F.coalesce("level", F.lit(0.0)).alias("level")
    )
    goals = materialize(goals, "mix-levels")
    ranked = _ranked(sizes.join(goals, _same_source())).withColumn(
        "__step", F.floor(F.col("__rank.odds") / (1 + F.col("__rank.odds")) * STEPS)
    )
    ranked = ranked.select("source", "size", "target", "__whole", "__rank", "__step")
    steps = ranked.groupBy("source", "__step").agg(
        F.sum("size").alias("words"),
        F.sum(F.col("size") * F.col("__whole")).alias("certain"),
        F.max("target").alias("target"),
    )
    # at most STEPS rows per source
    null = F.col("source").isNull()
    upto = Window.partitionBy("source", null).orderBy(F.col("__step").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    need = F.col("target") - F.sum("certain").over(Window.partitionBy("source", null))
    bounds = steps.select(
        F.col("source").alias("__source"),
        F.col("__step").alias("__bound"),
        F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("before"),
        "words",
        need.alias("need"),
    ).filter("__bound IS NOT NULL")
    # the step in which the need is met; steps before it are taken whole
    bound = bounds.filter("before < need AND before + words >= need").groupBy("__source").agg(
        F.min(F.struct("__bound", "before", "need")).alias("b")
    )
    bound = bound.select("__source", "b.*")
    within = ranked.join(bound, _same_source() & (F.col("__step") == F.col("__bound")))
    running = Window.partitionBy("__source", F.col("__source").isNull()).orderBy("__rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    # the document at the end is taken if that comes nearer to the need than leaving it
    last = (
        within.withColumn("__in", 2 * earlier + F.col("size") <= 2 * F.col("need"))
        .filter("__in")
        .groupBy(F.col("__source").alias("__last_source"))
        .agg(F.max("__rank").alias("inside"))
    )
    start = bound.select(F.col("__source").alias("__bound_source"), (F.col("__bound") / STEPS).alias("floor"))
    cuts = (
        goals.join(start, F.col("__source").eqNullSafe(F.col("__bound_source")), "left")
        .join(last, F.col("__source").eqNullSafe(F.col("__last_source")), "left")
        .select("__source", "source_size", "target", "level", F.col("floor"), F.col("inside").alias("last"))
    )
    return materialize(cuts, "mix-cuts")


def copies_of(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (with __id, __text, __copy, __pref and source) and their source's plan and copies (column copies)."""
    met = rows.join(cuts, _same_source(), "left").drop("__source")
    ranked = _ranked(met)
    odds = F.col("__rank.odds")
    step = F.floor(odds / (1 + odds) * STEPS)
    taken = (step < F.col("floor") * STEPS) | (
        (step == F.col("floor") * STEPS) & (F.col("__rank") <= F.col("last"))
    )
    copies = F.col("__whole") + F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)
    return ranked.withColumn("copies", copies.cast("int"))


def _rows(docs: DataFrame, preference: str | None) -> DataFrame:
    """Every row of ``docs`` as a struct, with what its draw depends on."""
    text = text_of()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
        F.col("doc_id").alias("__id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(text.cast("binary")).alias("__text"),
    )
    parts = [F.coalesce(F.col("__id").cast("string"), F.lit("null")), F.col("source").isNull().cast("string")]
    same = F.md5(F.concat_ws(":", *parts, "__text", F.coalesce("source", F.lit(""))).cast("binary"))
    return rows.withColumn("__pref", _preference(preference)).withColumn("__same", same)


def _numbered(rows: DataFrame) -> tuple[DataFrame, bool]:
    """The rows without their documents, equal ones numbered from 0 in column __copy; whether there are any."""
    key = ["__id", "source", "size", "__text", "__same"]
    counted, found = materialize_measured(
        rows.groupBy(*key).agg(F.max("__pref").alias("__pref"), F.count(F.lit(1)).alias("__copies")),
        "mix-sizes",
        F.coalesce(F.max("__copies"), F.lit(0)).alias("most"),
    )
    if found["most"] <= 1:
        return counted.drop("__copies").withColumn("__copy", F.lit(0).cast("long")), False
    expanded = expand_rows(counted, "__copies", "__copy", most=found["most"])
    return materialize(expanded.drop("__copies"), "mix-copies"), True


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    preference: str | None = BY_WORDS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): size, source_size, target, taken, copies.

    ``preference`` names a column of positive numbers that raise a document's share within its
    source, or is BY_WORDS for the square root of its words; with None all are alike.

    * The size is the number of words of the whole text, 0 for NULL. A NULL source is a source.
      A source of size 0 has target 0 and gives nothing.
    * Rows that share a doc_id, or are equal, are drawn each on its own.
    * The words taken from a source miss its target by less than its longest document.
    * An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    sizes, _ = _numbered(_rows(docs, preference))
    cuts = plan(sizes, weights, total)
    return copies_of(sizes, cuts).select(
        F.col("__id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies",
    )


def take_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    preference: str | None = BY_WORDS,
) -> DataFrame:
    """The documents of the mix with all their columns, each as many times as it is taken."""
    rows = _rows(docs, preference)
    sizes, repeated = _numbered(rows)
    cuts = plan(sizes, weights, total)
    numbered = rows.withColumn("__copy", F.lit(0).cast("long"))
    if repeated:
        # equal rows are told apart by their place among all repeated rows
        again = sizes.filter("__copy > 0").select("__same").distinct()
        placed = number_rows(rows.join(again, "__same", "left_semi"), ["__same"], "__place", start=0)
        first = placed.groupBy("__same").agg(F.min("__place").alias("__first"))
        placed = placed.join(first, "__same").withColumn("__copy", F.col("__place") - F.col("__first"))
        once = numbered.join(again, "__same", "left_anti")
        numbered = once.unionByName(placed.select(*once.columns))
    taken = copies_of(numbered, cuts).filter("copies > 0")
    return taken.select("__doc", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("__doc.*")
