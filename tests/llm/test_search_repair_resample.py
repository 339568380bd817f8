"""Top-k search, conversation repair and importance resampling against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from plain import awkward, docs
from pyspark.sql import functions as F

from ledgerline.llm import bit_slices, resampling, turn_repair

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def plain_top(rows, asks, k, scale=256):
    good = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector]))
    found = []
    for at, (query, weights) in enumerate(good):
        if query is None or not asks(query):
            continue
        scores = [
            (-sum(a * b for a, b in zip(weights, v)), i is None, i or 0, i)
            for other, (i, v) in enumerate(good)
            if other != at
        ]
        found += [(query, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(found, key=repr)


def search(spark, rows, k=5, **blocks):
    df = spark.createDataFrame([(i, v, 1, "extra") for i, v in rows], VECTORS)
    out = bit_slices.top_k(df, F.col("vec_id") % 3 == 0, k, **blocks)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.3, 7)]) for k in range(n)]
    # a third of the rows are one vector, and some share an id
    rows += [(1000 + k, rows[1][1]) for k in range(n // 2)]
    rows += [(3, rows[5][1]), (3, rows[3][1]), (None, rows[2][1]), (None, rows[2][1]), (-6, [0.0] * 7)]
    nan, inf = float("nan"), float("inf")
    return rows + [(9, None), (12, [nan] * 7), (15, [inf] + [1.0] * 6), (18, [None] + [1.0] * 6), (21, []), (24, [3.0, -2.0])]


@pytest.mark.parametrize(("block_rows", "block_queries"), [(4096, 256), (16, 5), (65, 3)])
def test_top_k_equals_all_pairs(spark, block_rows, block_queries):
    rows = vectors(60, block_rows)
    found = search(spark, rows, block_rows=block_rows, block_queries=block_queries)
    assert found == plain_top(rows, lambda i: i % 3 == 0, 5)


def test_top_k_of_few_and_of_wide_numbers(spark):
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(0, [1.0]), (1, [-0.001])]) == [(0, 1, 1, -256)]
    wide = [(k, [1e6 * (k - 4), -3e5 / (k + 1), 0.25]) for k in range(12)]
    assert search(spark, wide, k=3) == plain_top(wide, lambda i: i % 3 == 0, 3)
    with pytest.raises(Exception, match="do not fit"):
        search(spark, [(0, [1e12, 1e12]), (1, [1e12, 1e12])])


def test_slices_add_up():
    rng = np.random.default_rng(4)
    values, weights = rng.integers(-200, 300, (130, 9)), rng.integers(-90, 90, (6, 9))
    low, widths, slices = bit_slices.slices_of(values)
    sums = bit_slices.summed(weights, widths, slices)
    total = sum(bit_slices._bits(s, 130).astype(np.int64) << p for p, s in enumerate(sums))
    shift = weights @ values.T - total
    assert (shift == shift[:, :1]).all()
    assert len(slices) == widths.sum() and (values >= low).all()


SYMBOLS = "suaoSUAOX"


def cheapest(symbols):
    """Costs and audits of all edits by trying every sequence, longest first in cost order."""
    steps = {"s": 1, "u": 2, "a": 3}
    legal = {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")}
    best = {}
    todo = [(0, 0, 0, "")]
    limit = 3 * len(symbols)
    while todo:
        at, state, cost, audit = todo.pop()
        if cost > limit or best.get((at, state), (limit + 1, "")) < (cost, audit):
            continue
        best[at, state] = (cost, audit)
        want = "a" if state == 2 else "u"
        moves = [(at, steps[want], 2, "I")]
        if at < len(symbols):
            symbol, more = symbols[at].lower(), symbols[at].isupper()
            moves.append((at + 1, state, 3, "D"))
            if symbols[at] != "X":
                moves.append((at + 1, steps[want], 2 + more, "R"))
                if (state, symbol) in legal:
                    moves.append((at + 1, steps[symbol], more + 0, "K"))
        todo += [(a, s, cost + c, audit + e) for a, s, c, e in moves]
    return min(best[len(symbols), s] for s in (0, 3) if (len(symbols), s) in best)


def test_automaton_equals_all_edits():
    automaton = turn_repair.Automaton()
    random.seed(11)
    every = ["".join(s) for n in range(4) for s in itertools.product(SYMBOLS, repeat=n)]
    every += ["".join(random.choices(SYMBOLS, k=random.randint(4, 6))) for _ in range(300)]
    for symbols in every:
        cost, plan = automaton.solve(symbols)
        assert (cost, plan.translate(str.maketrans(turn_repair.PLAN, turn_repair.AUDIT))) == cheapest(symbols), symbols
    # however many conversations, there are few nodes
    assert len(automaton.costs) < 40


TURNS = "conv_id long, turn long, role string, text string, cost string"


def plain_repair(rows):
    """Faults, cost, audit and repaired lines of one conversation."""
    rows = [(turn, role if role is not None else " ", text if text is not None else " ") for turn, role, text in rows]
    key = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
    seen, symbols = set(), ""
    faults = Counter()
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not stripped:
            faults["blank"] += 1
            symbol = "X"
        elif (role, text) in seen:
            faults["duplicate"] += 1
            symbol = "X"
        elif stripped[-1] not in ".!?":
            faults["truncated"] += 1
            symbol = symbol.upper()
        seen.add((role, text))
        symbols += symbol
    initials = [r[1][:1] for r in rows]
    faults["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    numbers = {r[0] for r in rows if r[0] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit = cheapest(symbols)
    lines, state, at = [], "", 0
    for edit in audit:
        want = "assistant" if state == "u" else "user"
        role, text = rows[at][1:] if at < len(rows) else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        lines.append((want, "") if edit == "I" else (want, text) if edit == "R" else (role, text))
        state = lines[-1][0][0]
    return (gaps, *[faults[f] for f in ("blank", "duplicate", "truncated", "illegal")], cost, audit, lines)


def test_repair_of_awkward_conversations(spark):
    random.seed(3)
    texts = ["Good.", "So?", "cut off", "", " \n", None, "Good.", "é!  "]
    conversations = {k: [(n, random.choice(["system", "user", "assistant", "tool", None, ""]), random.choice(texts)) for n in range(random.randint(1, 6))] for k in range(40)}
    conversations[50] = [(5, "user", "Hi."), (5, "user", "Hi."), (None, "assistant", "Yes."), (9, "assistant", "No")]
    conversations[None] = [(None, "user", "a."), (None, "user", "a."), (7, "assistant", "b.")]
    conversations[51] = [(-(9 * 10**18), "user", "a."), (9 * 10**18, "assistant", "w " * 100_000 + ".")]
    rows = [(c, t, r, x, "extra") for c, turns in conversations.items() for t, r, x in turns]
    random.shuffle(rows)
    found = {r["conv_id"]: r for r in turn_repair.repair(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(found) == set(conversations)
    for conv, turns in conversations.items():
        expected = plain_repair(turns)
        r = found[conv]
        gaps = expected[0] if expected[0] < 2**63 else None
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (gaps, *expected[1:7]), turns
        assert [(m.role, m.text) for m in r.messages] == expected[7], turns
    assert turn_repair.repair(spark.createDataFrame([], TURNS)).collect() == []


def test_conversations_over_many_slices(spark):
    """One conversation with most of the turns, of which many are copies, is cut into slices."""
    turns = [(1, k % 4000, ("user", "assistant")[k % 2], ("Same.", f"Turn {k}.")[k % 3 > 0]) for k in range(6000)]
    turns += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame([(*t, "x") for t in turns], TURNS)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marks = turn_repair.marked(df.drop("cost"))
        assert marks.select("__slice").distinct().count() > 3
        found = {r["conv_id"]: r for r in turn_repair.repair(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found[2].audit == "KK"
    own = [t[1:] for t in turns if t[0] == 1]
    copies = len(own) - len({t[1:] for t in own})
    assert (found[1].duplicate, found[1].truncated, found[1].gaps) == (copies, 0, 0)
    roles = "".join(m.role[0] for m in found[1].messages)
    assert re.fullmatch("s?(ua)*", roles) and len(found[1].audit) >= 6000


def test_damage_covers_every_kind(spark):
    rows = [(c, t, "assistant", "Well. So!", "x") for c in range(30) for t in range(4)]
    found = Counter((r.conv_id, r.turn, r.role, r.text) for r in turn_repair.damage(spark.createDataFrame(rows, TURNS)).collect())
    expected = Counter()
    for c, t, role, text, _ in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = {1: "", 2: "Well So"}.get(kind, text)
        expected[c, t, "user" if kind == 4 else role, text] += {0: 0, 3: 2}.get(kind, 1)
    assert found == +expected
    lost = [(c, 0, "user", "x") for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(*r, "x") for r in lost], TURNS)
    empty = hashlib.sha256(b"").hexdigest()
    assert lost and {tuple(r)[1:] for r in turn_repair.repair_damaged(df).collect()} == {(0, 0, 0, 0, 0, 0, "", empty)}


def buckets_of(text, buckets, longest):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(found[k : k + n]) for n in range(1, longest + 1) for k in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain_resample(rows, target, percent, min_words, buckets, longest):
    found = [buckets_of(text, buckets, longest) for _, text in rows]
    s = Counter(b for _, own in found for b in own)
    t = Counter(b for text in target for b in buckets_of(text, buckets, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gains = [
        math.floor(1000 * math.log(((t[b] + 1) * (all_s + buckets)) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    ]
    out = []
    for (doc_id, _), (n_words, own) in zip(rows, found, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gains[b] for b in own)
        out.append((doc_id, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    long = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter((r[0], r[4], k + 1) for k, r in enumerate(long[: percent * len(long) // 100]))
    return out, drawn


@pytest.mark.parametrize(("percent", "longest", "buckets"), [(10, 1, 10_000), (60, 2, 70_000), (100, 3, 500)])
def test_resample_equals_plain(spark, percent, longest, buckets):
    random.seed(percent)
    vocabulary = [f"w{k}é" for k in range(300)] + ["Cat", "dog", "B2"]
    rows = [(k, " ".join(random.choices(vocabulary, k=random.randint(3, 60)))) for k in range(300)]
    # copies of one row, and rows without an id that tie, hold a third
    rows += [rows[7]] * 80 + [(None, "cat dog b2 " * 9)] * 70
    rows += [(r[0], r[1]) for r in awkward()]
    target = ["cat DOG b2 w1é w2é", None, "", "x" * 300 + " cat-dog"]
    df = docs(spark, [(i, text, "en", "s", 1) for i, text in rows], clash=["rank", "score", "bucket"])
    wanted = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    found = resampling.resample(df, wanted, percent, min_words=5, buckets=buckets, longest=longest).collect()
    expected, drawn = plain_resample(rows, target, percent, 5, buckets, longest)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in found) == Counter(expected)
    assert Counter((r.doc_id, r.score, r["rank"]) for r in found if r["rank"] is not None) == drawn


def test_resample_of_nothing(spark):
    none = docs(spark, [])
    some = docs(spark, [(k, "a b c d e f " * 4, "en", "s", 1) for k in range(30)], clash=["weight"])
    assert resampling.resample(none, some.select("text")).collect() == []
    assert sum(r["rank"] is not None for r in resampling.resample(some, none.select("text")).collect()) == 3
    assert all(r["rank"] is None for r in resampling.resample(some.limit(5), some.select("text")).collect())
    kept = resampling.keep_drawn(some, some.select("text"), percent=50)
    assert kept.columns == some.columns and kept.count() == 15


def test_bracket_holds_the_cutoff(spark):
    """Whatever the scores look like, the counted bracket holds the wanted one; the sketch only makes it narrow."""
    random.seed(9)
    scores = [random.choice([5, 5, 5, 900, random.randint(-(10**6), 10**6)]) for _ in range(20_000)]
    df = spark.createDataFrame([(s,) for s in scores], "score long")
    scores.sort(reverse=True)
    for wanted in (1, 199, 2000, 10_000, 19_999, 20_000):
        low, high, above = resampling.bracket(df, wanted, len(scores), accuracy=100)
        assert low <= scores[wanted - 1] <= high or above == wanted
        assert above == sum(s > high for s in scores) <= wanted <= sum(s >= low for s in scores)
