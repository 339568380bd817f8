"""Running sums and numbering: slices and plain windows must agree."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerline.operators import ordered, reshape


@pytest.fixture(scope="module")
def entries(spark):
    """One key owns more than a third of the rows, and many of its days tie."""
    draw = random.Random(7)
    data = []
    for i in range(3000):
        key = 1 if draw.random() < 0.4 else draw.choice([None, 2, 3, 4, 5])
        data.append((key, draw.randrange(20), f"R{i}", draw.randrange(-50, 100)))
    return spark.createDataFrame(data, "k int, day int, ref string, v long").cache()


def brute_running(data):
    totals, out = {}, []
    for k, day, ref, v in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2])):
        totals[k] = totals.get(k, 0) + v
        out.append((k, day, ref, v, totals[k]))
    return sorted(out, key=repr)


def hot_table(spark, entries, values):
    return spark.createDataFrame([(v,) for v in values], entries.select("k").schema)


def test_running_total_plain_and_sliced_agree(spark, entries):
    expected = brute_running([tuple(r) for r in entries.collect()])
    plain = ordered.running_total(entries, "k", ["day", "ref"], "v", "t", hot=hot_table(spark, entries, []))
    assert rows(plain) == expected
    for hot in ([1], [1, None], [None], [1, 2, 3, 4, 5, None]):
        sliced = ordered.running_total(entries, "k", ["day", "ref"], "v", "t", hot=hot_table(spark, entries, hot))
        assert rows(sliced) == expected, hot


def test_hot_key_is_spread_over_slices(spark, entries):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices, _ = ordered.sorted_slices(entries.filter("k = 1"), ["k", "day", "ref"])
        sizes = [r["count"] for r in slices.groupBy(ordered.SLICE).count().collect()]
        assert len(sizes) == 8
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        total = ordered.running_total(entries, "k", ["day", "ref"], "v", "t", hot=hot_table(spark, entries, [1]))
        assert rows(total) == brute_running([tuple(r) for r in entries.collect()])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_keys_are_those_of_large_groups(spark, entries):
    assert rows(ordered.hot_keys(entries, "k", rows=900)) == [(1,)]
    assert rows(ordered.hot_keys(entries, "k", rows=5000)) == []
    assert (None,) in rows(ordered.hot_keys(entries, "k", rows=100))


@pytest.fixture(params=["one slice", "many slices"])
def slicing(spark, request):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "one slice").lower())
    yield
    spark.conf.set(key, "true")


def test_number_rows_is_dense_and_follows_a_total_order(spark, slicing):
    draw = random.Random(3)
    data = [(draw.choice([None, 1, 2, 3]), draw.choice("abc")) for _ in range(500)]
    df = spark.createDataFrame(data, "a int, b string")
    got = [tuple(r) for r in ordered.number_rows(df, ["a"], "n").collect()]
    expected = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [r[1:] for r in sorted(got, key=lambda r: r[0])] == expected
    assert sorted(r[0] for r in got) == list(range(1, 501))


def test_number_rows_without_copies(spark, slicing):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    expected = sorted([(i + 5, 999 - i) for i in range(1000)], key=repr)
    for unique in (True, False):
        got = rows(ordered.number_rows(df, [F.desc("x")], "n", start=5, unique_rows=unique))
        assert got == expected


def test_number_rows_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert ordered.number_rows(df, ["a"], "n").count() == 0


def test_copies_of_one_row_are_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(reshape, "EXPAND_PIECE", 10)
    df = spark.createDataFrame([("x",)] * 95 + [("a",), ("z",)], "a string")
    got = rows(ordered.number_rows(df, ["a"], "n"), "n", "a")
    assert got == sorted([(1, "a")] + [(i, "x") for i in range(2, 97)] + [(97, "z")], key=repr)


def test_plain_ledger_window_lets_a_key_filter_through(spark, tmp_path, entries):
    path = str(tmp_path / "entries")
    entries.write.parquet(path)
    stored = spark.read.parquet(path)
    total = ordered.running_total(stored, "k", ["day", "ref"], "v", "t").filter("k = 2")
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,2)" in plan


def test_hot_join_key_is_split_by_adaptive_execution(spark):
    """A customer with a third of the sales does not end up in one join task."""
    from ledgerline.operators.keys import left_join_named

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sales = spark.range(0, 60000, 1, 6).select(
            F.col("id").alias("sale"),
            F.when(F.col("id") % 3 == 0, 1)
            .when(F.col("id") % 3 == 1, F.col("id") % 997)
            .cast("long")
            .alias("customer_id"),
        )
        people = spark.range(997).select(
            F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("name")
        )
        joined = left_join_named(sales, people, "customer_id")
        assert joined.count() == 60000
        named = sales.filter("customer_id IS NOT NULL").join(people, "customer_id", "left")
        named.collect()
        assert "skewed" in named._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_many_hot_groups_agree_with_the_plain_window(spark, tmp_path):
    """However many groups are hot, all are summed in slices, and none is collected."""
    df = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1500).alias("k"),
        F.col("id").alias("at"),
        (F.col("id") % 7).alias("v"),
    )
    hot = ordered.hot_keys(df, "k", 4)
    assert hot.count() > 1000
    assert rows(ordered.running_total(df, "k", ["at"], "v", "t", hot)) == rows(
        ordered.running_total(df, "k", ["at"], "v", "t")
    )


def test_many_copies_are_numbered_alike(spark, monkeypatch):
    df = spark.createDataFrame([("x", 1)] * 30 + [("a", 2), ("z", 0)], "a string, b int")
    plain = rows(ordered.number_rows(df, ["a"], "n"))
    monkeypatch.setattr(ordered, "MOST_COPIES", 5)
    assert rows(ordered.number_rows(df, ["a"], "n")) == plain
