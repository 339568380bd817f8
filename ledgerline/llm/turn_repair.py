"""Repair of conversations: the cheapest edits that make the roles of the turns legal.

Every turn becomes one symbol: the initial of its role and its fault. What the rest of a
conversation costs depends on its symbols alone, so conversations that end alike share the nodes
of one automaton, which is minimised from the end: a node is named by what the grammar states
cost relative to one another from there on. There are few such nodes, however many conversations
and however long. For each node, symbol and grammar state the cost-to-go and the first edit of the
best audit are computed once; an audit is read off by following them. No two edits that are
possible at one place begin with the same letter, so comparing first letters settles all ties.

Turns are sorted in slices, of which a long conversation fills several. In one task meets a
letter a turn of a conversation, which is the size of its audit, and, for the digest of a
repaired conversation, its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import POSITION, SLICE, sorted_slices
from ledgerline.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# what edits cost
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
FINAL = (0, 3)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# the role that a state wants next, and where it leads
WANTS = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
FAR = 1 << 40
# a plan's letters for re-roled and inserted turns, and their edits' initials
PLAN, AUDIT = "uaUA", "RRII"


def _best(options: list[list[tuple[int, str, int]]]) -> list[tuple[int, str, int]]:
    """Per state the cheapest option (cost, letter, next state), inserted turns included; ties to the least letter."""
    costs = [min((o[0] for o in own), default=FAR) for own in options]
    # more than two inserted turns in a row only come back to the same state
    for _ in range(3):
        costs = [min(costs[s], INSERT + costs[WANTS[s][1]]) for s in range(4)]
    return [
        min([*own, (INSERT + costs[WANTS[s][1]], "I", WANTS[s][1])], key=lambda o: o[:2]) for s, own in enumerate(options)
    ]


class Automaton:
    """Nodes by what the states cost from there on, and the solved step of every symbol onto them."""

    def __init__(self) -> None:
        self.names: dict[tuple[int, ...], int] = {}
        self.costs: list[tuple[int, ...]] = []
        self.steps: dict[tuple[str, int], tuple[int, int, list]] = {}
        # the end of a conversation: nothing more to do in a final state
        self.last = _best([[(0, "", s)] if s in FINAL else [] for s in range(4)])
        self.end, self.end_cost = self._node([o[0] for o in self.last])

    def _node(self, costs: list[int]) -> tuple[int, int]:
        least = min(costs)
        key = tuple(c - least for c in costs)
        if key not in self.names:
            self.names[key] = len(self.costs)
            self.costs.append(key)
        return self.names[key], least

    def before(self, symbol: str, node: int) -> tuple[int, int, list]:
        """The node before ``symbol``, the cost that it adds to all states, and every state's first edit."""
        known = self.steps.get((symbol, node))
        if known is None:
            after, options = self.costs[node], []
            role, more = symbol.lower(), TRUNCATED * symbol.isupper()
            for s in range(4):
                own = [(DELETE + after[s], "D", s)]
                if symbol != "X":
                    if (s, role) in KEEPS:
                        own.append((more + after[KEEPS[s, role]], "K", KEEPS[s, role]))
                    own.append((REROLE + more + after[WANTS[s][1]], "R", WANTS[s][1]))
                options.append(own)
            best = _best(options)
            known = self.steps[symbol, node] = (*self._node([o[0] for o in best]), best)
        return known

    def solve(self, symbols: str) -> tuple[int, str]:
        """What the best edits cost, and their plan: K, D, u and a (re-roled), U and A (inserted)."""
        node, cost = self.end, self.end_cost
        edits = [self.last]
        for symbol in reversed(symbols):
            node, added, best = self.before(symbol, node)
            cost += added
            edits.append(best)
        cost += self.costs[node][0]
        state, plan = 0, []
        while edits:
            _, letter, following = edits[-1][state]
            if letter == "I":
                plan.append(WANTS[state][0].upper())
            else:
                plan.append(WANTS[state][0] if letter == "R" else letter)
                edits.pop()
            state = following
        return cost, "".join(plan)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for batch in batches:
        found = [automaton.solve(s) for s in batch["symbols"].to_pylist()]
        costs, plans = [c for c, _ in found], [p for _, p in found]
        yield pa.RecordBatch.from_arrays(
            [batch["symbols"], pa.array(costs, pa.int64()), pa.array(plans, pa.string())],
            names=["symbols", "cost", "plan"],
        )


def turn_key() -> Column:
    """Equal for turns of equal role and text."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))


def marked(turns: DataFrame) -> DataFrame:
    """The turns in order (SLICE, POSITION) with their faults, stored; texts are left behind."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    marks = turns.select(
        "conv_id",
        "turn",
        turn_key().alias("key"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(*ENDS)).alias("cut"),
        # tells copies of a turn apart, so that they can be spread over slices
        F.monotonically_increasing_id().alias("__row"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("key"), F.col("__row")]
    slices, _ = sorted_slices(marks, order)
    place = F.struct(SLICE, POSITION)
    firsts = (
        slices.filter(~F.col("blank"))
        .groupBy(F.col("conv_id").alias("__conv"), F.col("key").alias("__key"))
        .agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("key") == F.col("__key"))
    seen = F.coalesce(place > F.col("__first"), F.lit(False)) & ~F.col("blank")
    found = slices.join(firsts, same, "left").withColumn("duplicate", seen)
    faulty = F.col("blank") | F.col("duplicate")
    symbol = F.when(faulty, "X").when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    return found.select(
        "conv_id", "turn", SLICE, POSITION, "initial", "blank", "duplicate",
        (F.col("cut") & ~faulty).alias("truncated"), symbol.alias("symbol"),
    )


def _joined(order: str, *names: str) -> list[Column]:
    """The strings of a group, put together in order."""
    rows = F.sort_array(F.collect_list(F.struct(order, *names)))

    def joined(name: str) -> Column:
        return F.array_join(F.transform(rows, lambda row: row[name]), "").alias(name)

    return [joined(name) for name in names]


def plans(turns: DataFrame) -> DataFrame:
    """One stored row per conversation of ``turns`` (conv_id, turn, role, text, without NULL texts or roles).

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, plan, audit.
    """
    marks = materialize(marked(turns), "turns")
    parts = marks.groupBy("conv_id", SLICE).agg(
        *_joined(POSITION, "initial", "symbol"),
        *[F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    texts = parts.groupBy("conv_id").agg(
        *_joined(SLICE, "initial", "symbol"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    turn = F.col("turn").cast("decimal(20,0)")
    spans = marks.groupBy(F.col("conv_id").alias("__conv")).agg(
        (F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn)).alias("gaps")
    )
    convs = materialize(
        texts.join(spans, F.col("conv_id").eqNullSafe(F.col("__conv")))
        .withColumn("gaps", F.coalesce("gaps", F.lit(0)).try_cast("long"))
        .withColumn("illegal", (F.length("initial") - 1 - F.regexp_count("initial", F.lit("(?=su|ua|au)"))).cast("long"))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("symbol").alias("symbols")),
        "conversations",
    )
    solved = convs.select("symbols").distinct().mapInArrow(_solve, "symbols string, cost long, plan string")
    return materialize(
        convs.join(materialize(solved, "solved"), "symbols")
        .withColumn("audit", F.translate("plan", PLAN, AUDIT))
        .drop("symbols"),
        "plans",
    )


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the repaired turns (role, text), in order, by the plans of :func:`plans`."""
    rows = turns.groupBy(F.col("conv_id").alias("__conv")).agg(
        F.sort_array(F.collect_list(F.struct("turn", turn_key().alias("key"), "role", "text"))).alias("rows")
    )
    joined = found.select("conv_id", "plan").join(rows, F.col("conv_id").eqNullSafe(F.col("__conv")))
    # one element a turn of the input: what is inserted before it, and its own edit; the last holds what follows
    steps = F.split(F.regexp_replace("plan", "([KDua])", "$1 "), " ")
    none = F.lit(None).cast("struct<role:string,text:string>")

    def message(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), text.alias("text"))

    def inserted(step: Column, at: int) -> Column:
        letter = F.substring(step, at, 1)
        return (
            F.when(letter == "U", message(F.lit("user"), F.lit("")))
            .when(letter == "A", message(F.lit("assistant"), F.lit("")))
            .otherwise(none)
        )

    def apply(pair: Column) -> Column:
        step, row = pair["steps"], pair["rows"]
        edit = F.substring(step, -1, 1)
        own = (
            F.when(edit == "K", message(row["role"], row["text"]))
            .when(edit == "u", message(F.lit("user"), row["text"]))
            .when(edit == "a", message(F.lit("assistant"), row["text"]))
            .otherwise(none)
        )
        return F.array_compact(F.array(inserted(step, 1), inserted(step, 2), own))

    zipped = joined.select("conv_id", F.arrays_zip(steps.alias("steps"), F.col("rows").alias("rows")).alias("pairs"))
    return zipped.select("conv_id", F.flatten(F.transform("pairs", apply)).alias("messages"))


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults, edits and repaired turns.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, messages.

    * Turns are taken in order of ``turn``, NULL first; turns that share a number in order of a
      hash of role and text, so copies follow one another. NULL roles and texts read as one space.
    * A turn's first fault counts: blank, duplicate (of any earlier turn of equal role and text),
      truncated. Blank and duplicate turns are always deleted.
    * Roles count by their first character; one that is neither s, u nor a fits nowhere.
    * A NULL conv_id is a conversation of its own. ``gaps`` is NULL beyond 64 bits. An empty table
      gives no rows. Other columns are ignored.
    """
    named = _readable(turns)
    found = plans(named)
    texts = repaired(named, found).withColumnRenamed("conv_id", "__conv")
    return found.join(texts, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv", "plan")


def _readable(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with one in four damaged, by a checksum of conversation and turn.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it,
    and 4 makes its role user.
    """
    rows = _readable(turns)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy"),
    ).drop("__copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """:func:`repair` of the damaged ``turns``, with the digest of every repaired conversation.

    Conversations of which no row is left have zeros, an empty audit and the digest of an empty text.
    """
    found = repair(damage(turns))
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    digests = found.withColumn("repaired_sha256", F.sha2(lines.cast("binary"), 256)).drop("messages")
    every = turns.select(F.col("conv_id").cast("long").alias("__conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kept = F.col("__conv").eqNullSafe(F.col("conv_id"))
    left = F.col("audit").isNotNull()
    return every.join(digests, kept, "left").select(
        F.col("__conv").alias("conv_id"),
        *[F.when(left, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
