"""Splitting, unpivoting, replication and allocation, with properties."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows
from ledgerline.operators import allocate, reshape

quick = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_split_packed_trims_drops_blanks_and_repeats(spark):
    df = spark.createDataFrame([(1, " a ; ;b;a;"), (2, None), (3, ";")], "id int, cell string")
    assert rows(reshape.split_packed(df, ["id"], "cell", "part")) == [(1, "a"), (1, "b")]


def test_unpivot_drops_unused_slots_only(spark):
    df = spark.createDataFrame(
        [(1, "x", 2, None, None), (2, None, None, "y", 0)], "id int, n1 string, q1 int, n2 string, q2 int"
    )
    groups = [{"name": "n1", "qty": "q1"}, {"name": "n2", "qty": "q2"}]
    assert rows(reshape.unpivot_groups(df, ["id"], groups, "name")) == [
        (1, 1, "x", 2),
        (2, 2, "y", 0),
    ]


def test_expand_rows_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(reshape, "EXPAND_PIECE", 7)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), ("d", 30)], "k string, n long")
    expected = [(k, n, i) for k, n in (("b", 1), ("c", 7), ("d", 30)) for i in range(n)]
    assert rows(reshape.expand_rows(df, "n", "i")) == sorted(expected, key=repr)


def test_split_evenly_adds_up(spark):
    df = spark.createDataFrame([(1, 17, 5), (2, 2, 4), (3, 9, 3)], "p int, q int, k int")
    out = reshape.split_evenly(df, "q", "k", "part")
    got = rows(out, "p", "line_no", "part")
    assert [r[2] for r in got if r[0] == 1] == [4, 4, 3, 3, 3]
    assert [r[2] for r in got if r[0] == 2] == [1, 1, 1, 1]
    assert [r[2] for r in got if r[0] == 3] == [3, 3, 3]


@quick
@given(
    weights=st.lists(st.integers(0, 1000), min_size=1, max_size=12),
    total=st.integers(12, 5000),
    least=st.integers(0, 1),
)
def test_proportional_allocation_is_exact(spark, weights, total, least):
    df = spark.createDataFrame(list(enumerate(weights)), "id int, w long")
    out = allocate.proportional_allocation(df, "w", "id", total, min_each=least)
    got = {r["id"]: r["allocated"] for r in out.collect()}
    rest = total - least * len(weights)
    used = weights if sum(weights) else [1] * len(weights)
    assert sum(got.values()) == total
    for i, w in enumerate(used):
        exact = w * rest / sum(used)
        assert int(exact) <= got[i] - least <= int(exact) + 1


def test_allocation_rejects_a_minimum_that_does_not_fit(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "id int, w long")
    with pytest.raises(Exception, match="minimum for each row"):
        allocate.proportional_allocation(df, "w", "id", 3, min_each=2).collect()


def brute_fifo(charges, payments):
    """Settle charge by charge, payment by payment."""
    out = []
    for key in {c[0] for c in charges}:
        due = [[i, a] for k, i, a in charges if k == key]
        paid = [[i, a] for k, i, a in payments if k == key]
        while due and paid:
            used = min(due[0][1], paid[0][1])
            if used:
                out.append((key, due[0][0], paid[0][0], used))
            due[0][1] -= used
            paid[0][1] -= used
            if due[0][1] == 0:
                due.pop(0)
            if paid and paid[0][1] == 0:
                paid.pop(0)
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, False)])
def test_fifo_allocation_against_brute_force(spark, seed, hot, monkeypatch):
    draw = random.Random(seed)
    # few distinct amounts, so that interval ends tie; zeros included
    charges = [(draw.choice([1, 1, 2, 3]), i, draw.choice([0, 5, 10])) for i in range(60)]
    payments = [(draw.choice([1, 1, 2, 4]), i, draw.choice([0, 5, 10, 15])) for i in range(40)]
    if hot:
        monkeypatch.setattr("ledgerline.operators.ordered.HOT_GROUP_ROWS", 5)
    out = allocate.fifo_allocation(
        spark.createDataFrame(charges, "k int, c int, amount long"),
        spark.createDataFrame(payments, "k int, p int, amount long"),
        "k", "c", "p", ["c"], ["p"],
    )
    assert rows(out, "k", "c", "p", "allocated") == brute_fifo(charges, payments)


@pytest.mark.parametrize("hot", [False, True])
def test_capped_payments_never_exceed_charges(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr("ledgerline.operators.ordered.HOT_GROUP_ROWS", 1)
    payments = spark.createDataFrame(
        [(1, 1, 40), (1, 2, 70), (1, 3, 5), (2, 4, 9), (3, 5, 1)], "k int, id int, a long"
    )
    charged = spark.createDataFrame([(1, 100), (2, 50)], "k int, charged long")
    out = allocate.capped_payments(payments, charged, "k", ["id"], "a", "ok")
    assert rows(out, "id", "ok") == [(1, 40), (2, 60), (3, 0), (4, 9), (5, 0)]
