"""Allow and block rules for URLs by host and path, resolved by a sort-merge range join.

The labels of a host in reverse order, each followed by a dot, are its canonical key. A host and
all its subdomains then lie in one interval of keys, and the intervals of rules are nested or
apart. One sorted sweep over the distinct hosts and the ends of the intervals keeps the stack of
rules that are active: a rule's begin puts it on the stack of the rules around it, its end brings
their stack back, so the stack at a host is that of the last end before it.

The sweep is cut into sorted slices. A slice takes its first stack from the last end in the slices
before it, so no slice waits for another and none holds a fixed share of the hosts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.ordered import POSITION, SLICE, sorted_slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
RULE_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, question mark, hash or the end, A to Z lowered."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    return spark.createDataFrame([(host, path, verdict) for verdict, host, path in rules], RULE_SCHEMA)


def _stacks(rules: DataFrame) -> DataFrame:
    """Per host with rules: its key, the rules of the hosts around it, and those with its own."""
    own = rules.groupBy("host").agg(
        F.collect_set(
            F.struct(
                (F.length("host") + F.length("path")).alias("size"),
                F.length("host").alias("host_size"),
                # of equal rules with both verdicts, block wins
                (F.col("verdict") == BLOCK).cast("int").alias("blocks"),
                F.concat("host", "path").alias("rule"),
                "path",
                "verdict",
            )
        ).alias("rules")
    )
    labels = F.split("host", r"\.")
    # a host lies in as many hosts as it has labels
    around = own.select(
        "host",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
            )
        ).alias("outer"),
    )
    outer = own.select(F.col("host").alias("outer"), F.col("rules").alias("outer_rules"))
    chains = around.join(outer, "outer").groupBy("host").agg(
        F.flatten(F.collect_list("outer_rules")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("outer") != F.col("host"), F.col("outer_rules")))).alias("outside"),
    )
    return chains.select(host_key(F.col("host")).alias("key"), "inside", "outside")


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack) for every distinct host of ``hosts``: the rules of it and of the hosts around it."""
    stacks = _stacks(rules)
    # every key that begins with "a.b." is below "a.b/", since the slash follows the dot
    begins = stacks.select("key", F.struct(F.col("inside").alias("rules")).alias("stack"))
    ends = stacks.select(
        F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/")).alias("key"),
        F.struct(F.col("outside").alias("rules")).alias("stack"),
    )
    nothing = F.lit(None).cast(begins.schema["stack"].dataType)
    swept = (
        hosts.select("host").distinct().select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), nothing.alias("stack"), "host")
        .unionByName(begins.unionByName(ends).select("key", F.lit(0).alias("kind"), "stack", F.lit(None).cast("string").alias("host")))
    )
    slices, _ = sorted_slices(swept, ["key", "kind"])
    # one row per slice
    last = slices.filter("kind = 0").groupBy(SLICE).agg(F.max_by("stack", POSITION).alias("last"))
    sizes = slices.select(F.col(SLICE).alias("__slice_no")).distinct()
    before = Window.partitionBy(F.lit(0)).orderBy("__slice_no").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.join(last, F.col("__slice_no") == F.col(SLICE), "left").select(
        "__slice_no", F.last("last", ignorenulls=True).over(before).alias("carried")
    )
    upto = Window.partitionBy(SLICE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    current = slices.select(SLICE, "kind", "host", F.last("stack", ignorenulls=True).over(upto).alias("stack"))
    return (
        current.filter("kind = 1")
        .join(carried, F.col(SLICE) == F.col("__slice_no"))
        .select("host", F.coalesce(F.coalesce("stack", "carried")["rules"], _no_rules(begins)).alias("stack"))
    )


def _no_rules(begins: DataFrame) -> Column:
    return F.array().cast(begins.schema["stack"].dataType["rules"].dataType)


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = ALLOW) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the path
    begins with the rule's. Of those that fit the longest wins, by the length of host and path,
    then of the host; a URL that none fits gets ``otherwise``.

    * A url that is NULL or has no :// has an empty host and path.
    * Rules with a NULL host, path or verdict never fit. Of equal rules with different verdicts
      block wins. Repeated rules count once.
    * Rows of equal urls get a row each. An empty table gives none. Other columns are ignored.
    """
    rules = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    url = F.col("url").cast("string")
    split = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    met = split.join(active_rules(split, rules), "host", "left")
    path = F.col("path")
    best = F.array_max(F.filter("stack", lambda r: path.startswith(r["path"])))
    return met.select("page_id", "host", "path", best.alias("best")).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(otherwise)).alias("verdict"),
    )
