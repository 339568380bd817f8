"""Totals over joins that are moved by changes equal their full computation."""

import random
from collections import Counter

import pytest
from helpers import rows

from ledgerline.session import scratch_path
from ledgerline.streaming import joined
from ledgerline.streaming.joined import JoinedTotal, apply_changes, changed_rows, compact, follow, totals

TOTAL = JoinedTotal("sale", "customer", {"cents": "units * price", "units": "units"}, "kind = 'credit'", buckets=4)
SALE = "sale long, customer long, kind string, weight long"
LINE = "sale long, units int, price int, weight long"


def batches(seed, n=6):
    """Random changes: (headers, lines) with weights, as rows; a row taken away was there."""
    random.seed(seed)
    sales, lines, out = Counter(), Counter(), []
    for _ in range(n):
        heads, own = Counter(), Counter()
        for _ in range(random.randint(0, 8)):
            heads[random.randrange(12), random.choice([1, 2, None]), random.choice(["credit", "cash"])] += 1
        for _ in range(random.randint(0, 15)):
            own[random.choice([*range(12), 3, 3, 3, None]), random.randint(1, 5), random.randint(1, 9)] += 1
        for row in random.sample(list(sales), min(len(sales), random.randint(0, 4))):
            heads[row] -= sales[row]
        for row in random.sample(list(lines), min(len(lines), random.randint(0, 6))):
            own[row] -= 1
        sales += heads
        lines += own
        sales, lines = +sales, +lines
        out.append(([(*r, w) for r, w in heads.items()], [(*r, w) for r, w in own.items()]))
    return out


def expected(applied):
    sums = Counter()
    units = Counter()
    heads, own = Counter(), Counter()
    for headers, lines in applied:
        for *row, w in headers:
            heads[tuple(row)] += w
        for *row, w in lines:
            own[tuple(row)] += w
    for (sale, customer, kind), w in heads.items():
        for (of, n, price), v in own.items():
            if sale is not None and sale == of and kind == "credit" and customer is not None:
                sums[customer] += w * v * n * price
                units[customer] += w * v * n
    return {(c, sums[c], units[c]) for c in sums if sums[c] or units[c]}


def found(spark, root):
    return {tuple(r) for r in totals(spark, TOTAL, root).collect() if r.cents or r.units}


def frames(spark, batch):
    return spark.createDataFrame(batch[0], SALE), spark.createDataFrame(batch[1], LINE)


@pytest.mark.parametrize("seed", range(3))
def test_totals_equal_recomputation(spark, seed):
    root = scratch_path(spark, "kept")
    done = []
    for batch_id, batch in enumerate(batches(seed)):
        apply_changes(TOTAL, root, batch_id, *frames(spark, batch))
        done.append(batch)
        if batch_id == 2:
            # a batch that failed late runs again, and replaces what it wrote
            apply_changes(TOTAL, root, batch_id, *frames(spark, batch))
        assert found(spark, root) == expected(done)
    target = scratch_path(spark, "kept")
    compact(spark, TOTAL, root, target, last=3)
    assert found(spark, target) == expected(done)
    more = ([(5, 1, "credit", 1)], [(5, 3, 3, 1)])
    apply_changes(TOTAL, target, 6, *frames(spark, more))
    assert found(spark, target) == expected([*done, more])


def test_one_side_only(spark):
    root = scratch_path(spark, "kept")
    headers, lines = frames(spark, ([(1, 7, "credit", 1)], [(1, 2, 5, 1), (1, 1, 1, 1)]))
    apply_changes(TOTAL, root, 0, lines=lines)
    apply_changes(TOTAL, root, 1, headers=headers)
    assert found(spark, root) == {(7, 11, 3)}
    moved = changed_rows(headers.drop("weight"), headers.drop("weight").selectExpr("sale", "8L AS customer", "kind"))
    apply_changes(TOTAL, root, 2, headers=moved)
    apply_changes(TOTAL, root, 3, lines=changed_rows(before=lines.drop("weight").filter("units = 2")))
    assert found(spark, root) == {(8, 1, 1)}


def test_a_batch_reads_the_buckets_it_changes(spark):
    root = scratch_path(spark, "kept")
    lines = spark.range(200).selectExpr("id AS sale", "1 AS units", "1 AS price", "1L AS weight")
    apply_changes(TOTAL, root, 0, lines=lines)
    net = joined.net_headers(TOTAL, spark.createDataFrame([(3, 1, "credit", 1)], SALE))
    wanted = joined._buckets(net)
    logged = joined._log(spark, f"{root}/lines", joined._line_schema(TOTAL, net), 1, wanted)
    assert len(wanted) == 1 and {f.split("bucket=")[1][0] for f in logged.inputFiles()} <= {"0", "1", "2", "3"}
    plan = logged._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < logged.count() < 200


def test_stream_with_a_restart(spark, tmp_path):
    root, checkpoint, source = (scratch_path(spark, n) for n in ("kept", "checkpoint", "changes"))
    schema = "side string, sale long, customer long, kind string, units int, price int, weight long"
    todo = batches(9, 4)

    def arrive(some):
        for headers, lines in some:
            changes = [("header", s, c, k, None, None, w) for s, c, k, w in headers]
            changes += [("line", s, None, None, u, p, w) for s, u, p, w in lines]
            spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        follow(stream, TOTAL, root, checkpoint).awaitTermination()

    arrive(todo[:2])
    run()
    assert found(spark, root) == expected(todo[:2])
    arrive(todo[2:])
    run()
    assert found(spark, root) == expected(todo)


def test_rows_helper_keeps_weights(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert rows(changed_rows(df, df)) == [(1, -1), (1, 1)]
    assert rows(changed_rows(after=df)) == [(1, 1)]
