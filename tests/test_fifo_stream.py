"""Streaming allocation equals allocating everything at once."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from ledgerline.session import scratch_path
from ledgerline.streaming import fifo

START = datetime(2025, 1, 1)


def entries(seed, n=120):
    random.seed(seed)
    out = []
    for k in range(n):
        customer = random.choice([1, 1, 1, 2, 3, None])
        side = random.choice(["charge", "payment"])
        out.append((customer, side, k, START + timedelta(hours=random.randrange(24 * 90)), random.choice([0, 100, 250, 999])))
    return out


def at_once(rows):
    found = {}
    for customer in {r[0] for r in rows if r[0] is not None}:
        queues = []
        for side in ("charge", "payment"):
            own = sorted((r[3], r[2], r[4]) for r in rows if r[0] == customer and r[1] == side and r[4] > 0)
            queues.append([[k, i, cents] for k, (_, i, cents) in enumerate(own)])
        charges, payments = queues
        while charges and payments:
            part = min(charges[0][2], payments[0][2])
            found[customer, charges[0][1], payments[0][1]] = part
            for queue in (charges, payments):
                queue[0][2] -= part
                if not queue[0][2]:
                    queue.pop(0)
    return found


def arrive(spark, rows, folder):
    spark.createDataFrame(rows, fifo.ENTRY).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, path, checkpoint, **more):
    stream = spark.readStream.schema(fifo.ENTRY).option("maxFilesPerTrigger", 1).parquet(folder)
    fifo.fifo_stream(stream, path, checkpoint, **more).awaitTermination()


def found(spark, path):
    return {(r.customer_id, r.transaction_id, r.payment_id): r.cents for r in fifo.current_allocations(spark, path).collect()}


def test_any_order_and_a_restart(spark):
    folder, path, checkpoint = (scratch_path(spark, n) for n in ("entries", "moves", "checkpoint"))
    rows = entries(1)
    for part in (rows[:40], rows[40:50]):
        arrive(spark, part, folder)
    run(spark, folder, path, checkpoint)
    assert found(spark, path) == at_once(rows[:50])
    # the stream goes on from its state; most of what comes is older than what was settled
    for part in (rows[50:90], rows[90:]):
        arrive(spark, part, folder)
    run(spark, folder, path, checkpoint)
    assert found(spark, path) == at_once(rows)


def test_late_charge_takes_payments_back(spark):
    folder, path, checkpoint = (scratch_path(spark, n) for n in ("entries", "moves", "checkpoint"))
    arrive(spark, [(1, "charge", 10, START + timedelta(days=5), 300), (1, "payment", 7, START + timedelta(days=6), 200)], folder)
    run(spark, folder, path, checkpoint)
    assert found(spark, path) == {(1, 10, 7): 200}
    arrive(spark, [(1, "charge", 11, START, 150)], folder)
    run(spark, folder, path, checkpoint)
    assert found(spark, path) == {(1, 11, 7): 150, (1, 10, 7): 50}


def test_watermark_reports_open_charges_and_forgets_settled_ones(spark):
    folder, path, checkpoint = (scratch_path(spark, n) for n in ("entries", "moves", "checkpoint"))
    day = lambda n: START + timedelta(days=n)
    waves = [
        [(1, "charge", 1, day(0), 500), (1, "payment", 2, day(1), 500), (2, "charge", 3, day(1), 700)],
        [(2, "payment", 4, day(3), 200), (1, "charge", 5, day(4), 900), (1, "payment", 6, day(4), 100)],
        [(3, "charge", 7, day(60), 50)],
        [(3, "payment", 8, day(61), 50)],
    ]
    for wave in waves:
        arrive(spark, wave, folder)
        run(spark, folder, path, checkpoint, late_by="2 days", open_days=30)
    rows = [r for wave in waves for r in wave]
    assert found(spark, path) == at_once(rows)
    late = {(r.customer_id, r.transaction_id, r.cents) for r in fifo.overdue(spark, path).collect()}
    assert late == {(2, 3, 500), (1, 5, 800)}


@pytest.mark.parametrize("seed", range(30))
def test_settled_entries_do_not_change_later_allocations(seed):
    random.seed(seed)
    queue = lambda first: np.array([(first + k, k + first, random.randint(1, 9)) for k in range(random.randint(0, 8))], np.int64).reshape(-1, 3)
    charges, payments = queue(0), queue(0)
    whole = fifo.allocations(charges, payments, 0, 0)
    c, p, charged, paid = fifo._settled(charges, payments, 0, 0, before=random.randint(0, 9))
    kept = fifo.allocations(c, p, charged, paid)
    assert kept.items() <= whole.items()
    gone = {k: v for k, v in whole.items() if k not in kept}
    later = np.array([(100, 100, 20)], np.int64)
    more = fifo.allocations(np.concatenate([charges, later]), np.concatenate([payments, later]), 0, 0)
    assert {**gone, **fifo.allocations(np.concatenate([c, later]), np.concatenate([p, later]), charged, paid)} == more


def test_one_call_settles_many_customers(spark, monkeypatch):
    """Customers share buckets, and each gets what it would get alone, in every wave and after a restart."""
    monkeypatch.setattr(fifo, "BUCKETS", 2)
    folder, path, checkpoint = (scratch_path(spark, n) for n in ("entries", "moves", "checkpoint"))
    random.seed(5)
    rows = [
        (random.randrange(-40, 40), random.choice(["charge", "payment"]), k, START + timedelta(hours=random.randrange(2000)), random.randrange(1, 900))
        for k in range(900)
    ]
    for part in (rows[:400], rows[400:410], rows[410:]):
        arrive(spark, part, folder)
        run(spark, folder, path, checkpoint)
    assert found(spark, path) == at_once(rows)
    calls = fifo.moves(spark.readStream.schema(fifo.ENTRY).parquet(folder))
    assert "pmod" in calls._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("seed", range(20))
def test_buckets_forget_what_each_customer_would(seed):
    random.seed(seed)
    queue = lambda first: np.array([(first + k, k + first, random.randint(1, 9)) for k in range(random.randint(0, 8))], np.int64).reshape(-1, 3)
    alone = {customer: (queue(0), queue(0)) for customer in (-3, 0, 7)}
    joined = [np.concatenate([np.column_stack([np.full(len(q[side]), c), q[side]]) for c, q in alone.items()]) for side in (0, 1)]
    lines = fifo._lines_of(np.zeros((0, 4), np.int64), *joined)
    before = random.randint(0, 9)
    charges, payments, lines = fifo._forget(*joined, lines, before)
    for customer, (c, p) in alone.items():
        c, p, charged, paid = fifo._settled(c, p, 0, 0, before)
        assert (charges[charges[:, 0] == customer][:, 1:] == c).all() and (payments[payments[:, 0] == customer][:, 1:] == p).all()
        assert [line[1:3].tolist() for line in lines if line[0] == customer] in ([[charged, paid]], [])
