"""Merged profiles equal the profile of everything, exactly or within the sketches' errors."""

import random
from datetime import date, datetime

import pytest

from ledgerline.operators import profile
from ledgerline.session import scratch_path

SCHEMA = "id long, price double, day date, at timestamp, name string, flag boolean, gone int, list array<int>"


def rows_of(n, seed):
    random.seed(seed)
    return [
        (random.randrange(5 * n), random.choice([None, random.random() * 100]), date(2025, 1, 1 + k % 28),
         datetime(2025, 2, 1 + k % 28, 5), random.choice(["a", "b", None, f"n{k}"]), k % 3 == 0, None, [1])
        for k in range(n)
    ]


def test_merged_profiles(spark):
    parts = [rows_of(3000, 1), rows_of(2000, 2), []]
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    root = scratch_path(spark, "profiles")
    for k, df in enumerate(frames):
        profile.save({"t": df}, root, f"load{k}")
        profile.save({"t": df}, root, f"load{k}")
    found = {r.column_name: r for r in profile.readable(profile.merged(spark.read.parquet(root))).collect()}
    every = [r for p in parts for r in p]
    assert set(found) == set("id price day at name flag gone".split())
    for k, column in enumerate("id price day at name flag gone".split()):
        values = [r[k] for r in every if r[k] is not None]
        r = found[column]
        assert (r.n_rows, r.n_null) == (5000, 5000 - len(values))
        assert r.n_distinct == pytest.approx(len(set(values)), rel=0.05)
    prices = sorted(r[1] for r in every if r[1] is not None)
    assert (found["price"].least, found["price"].most) == (prices[0], prices[-1])
    for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        rank = sum(p <= found["price"][name] for p in prices) / len(prices)
        assert abs(rank - q) <= profile.RANK_ERROR
    assert (found["name"].least_text, found["name"].most_text) == ("a", max(r[4] for r in every if r[4]))
    assert found["day"].least == (date(2025, 1, 1) - date(1970, 1, 1)).days and found["gone"].q50 is None
    whole = profile.profile(spark.createDataFrame(every, SCHEMA), "t")
    agreed = profile.agreement(profile.merged(spark.read.parquet(root)), whole).collect()
    assert len(agreed) == 7 and all(r.distinct_agree and r.quantiles_agree for r in agreed)
