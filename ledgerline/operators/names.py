"""Names that mean the same thing but were typed differently.

Names are compared without regard to case and blanks; numbers in them must agree, since 320 ml is
not 330 ml. Two names that differ by one edit of a letter (or two, if asked for) share a pattern:
the text that is left when the differing letters are cut out or replaced by a blank space. Every
distinct name is sent to the places of all its patterns. Who meets in one place is within the
distance by construction, so a place needs no comparison of all pairs: linking everyone to one
name of the place connects the same names. Names whose numbers nobody else has meet nobody, and the
few names that share rare numbers are compared as they are, which takes far less than their
patterns. Linked names form a cluster, whose most frequent spelling stands for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.components import components
from ledgerline.session import materialize

# takes the place of a replaced letter in a pattern
GAP = "\x01"
# up to so many names with the same numbers are compared pair by pair
MOST_IN_PAIRS = 16


def normal_name(name: str) -> Column:
    """Lower case, single blanks, no blanks around."""
    return F.trim(F.regexp_replace(F.lower(F.col(name)), r"\s+", " "))


def _edits(key: Column, cut: Column, gaps: Column) -> Column:
    """The patterns one edit further: every letter cut out, and every letter replaced."""

    def at(i: Column) -> Column:
        before, letter, after = F.substring(key, F.lit(1), i - 1), F.substring(key, i, F.lit(1)), F.substring(key, i + 1, F.length(key))
        pattern = [
            F.struct(F.concat(before, after).alias("key"), (cut + 1).alias("cut"), gaps.alias("gaps")),
            F.struct(F.concat(before, F.lit(GAP), after).alias("key"), cut.alias("cut"), (gaps + 1).alias("gaps")),
        ]
        return F.when(letter != GAP, F.array(*pattern)).otherwise(F.array().cast("array<struct<key:string,cut:int,gaps:int>>"))

    empty = F.array().cast("array<struct<key:string,cut:int,gaps:int>>")
    return F.when(F.length(key) > 0, F.flatten(F.transform(F.sequence(F.lit(1), F.length(key)), at))).otherwise(empty)


def patterns(letters: Column, distance: int) -> Column:
    """All patterns (key, cut, gaps) of a name with at most ``distance`` letters cut out or replaced."""
    found = F.array(F.struct(letters.alias("key"), F.lit(0).alias("cut"), F.lit(0).alias("gaps")))
    reached = found
    for _ in range(distance):
        reached = F.array_distinct(F.flatten(F.transform(reached, lambda p: _edits(p["key"], p["cut"], p["gaps"]))))
        found = F.concat(found, reached)
    return F.array_distinct(found)


def links(names: DataFrame, distance: int = 1) -> DataFrame:
    """Pairs (a, b) of names within ``distance`` edits, enough to connect all that are connected.

    ``names`` has one row per name: name, letters (compared by edits), numbers (compared as they
    are). Small groups of names with the same numbers are compared pair by pair, all others meet by
    their patterns.
    """
    # the gap is no letter to patterns, so names that hold it go by patterns in any case
    groups = names.groupBy("numbers").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("letters").contains(GAP)).alias("odd")
    )
    met = materialize(names.join(groups.filter("n > 1"), "numbers"), "names-by-numbers")
    few = (F.col("n") <= MOST_IN_PAIRS) & ~F.col("odd")
    left = met.filter(few).select("numbers", F.col("name").alias("a"), F.col("letters").alias("a_letters"))
    right = met.filter(few).select("numbers", F.col("name").alias("b"), F.col("letters").alias("b_letters"))
    near = F.levenshtein("a_letters", "b_letters", distance) >= 0
    pairs = left.join(right, "numbers").filter((F.col("a") < F.col("b")) & near).select("a", "b")
    return pairs.unionByName(_links_by_patterns(met.filter(~few).select(*names.columns), distance))


def _links_by_patterns(names: DataFrame, distance: int) -> DataFrame:
    """:func:`links` by the places of patterns.

    In the place of a pattern, a name from which nothing was cut is within the distance of all
    others; names from which one letter each was cut are within two edits of each other.
    """
    placed = names.select("name", "numbers", F.inline(patterns(F.col("letters"), distance)))
    placed = materialize(placed, "patterns")
    whole, once = F.col("cut") == 0, (F.col("cut") == 1) & (F.col("gaps") + 2 <= distance)
    hubs = (
        placed.groupBy("numbers", "key", "gaps")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(whole, F.col("name"))).alias("hub"),
            F.min(F.when(once, F.col("name"))).alias("second"),
        )
        .filter("n > 1")
        .filter(F.coalesce("hub", "second").isNotNull())
        .drop("n")
    )
    met = placed.join(hubs, ["numbers", "key", "gaps"])
    other = F.coalesce(F.col("hub"), F.when(once, F.col("second")))
    return (
        met.select(F.least("name", other).alias("a"), F.greatest("name", other).alias("b"), other.alias("other"))
        .filter(F.col("other").isNotNull() & (F.col("a") != F.col("b")))
        .select("a", "b")
        .distinct()
    )


def clusters(df: DataFrame, name: str, distance: int = 1) -> DataFrame:
    """One row per distinct name of ``df``: name, n_rows, cluster, n_names.

    ``cluster`` is the spelling with the most rows among the names connected by steps of at most
    ``distance`` edits, ties to the smallest; ``n_names`` counts the spellings. NULL names are left
    out. A name has about twice (for two edits, twice the square of) its length in patterns, so
    this is for names, not for texts.
    """
    counted = (
        df.filter(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("name"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("normal", normal_name("name"))
    )
    counted = materialize(counted, "names")
    distinct = counted.select("normal").distinct().select(
        F.col("normal").alias("name"),
        F.regexp_replace("normal", "[0-9]+", "0").alias("letters"),
        F.array_join(F.regexp_extract_all("normal", F.lit("[0-9]+"), F.lit(0)), " ").alias("numbers"),
    )
    found = components(materialize(links(distinct, distance), "name-links"))
    labelled = counted.join(found.withColumnRenamed("node", "normal"), "normal", "left").withColumn(
        "label", F.coalesce("label", "normal")
    )
    labelled = materialize(labelled, "labelled-names")
    # most rows first, then the smallest spelling
    best = F.min_by("name", F.struct(-F.col("n_rows"), F.col("name")))
    heads = labelled.groupBy("label").agg(best.alias("cluster"), F.count(F.lit(1)).alias("n_names"))
    return labelled.join(heads, "label").select("name", "n_rows", "cluster", "n_names")
