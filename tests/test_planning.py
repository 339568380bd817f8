"""Basket rules and demand forecasts against plain Python."""

import math
import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal as D
from itertools import combinations

import pytest
from shops import NOW, small_shop

from ledgerline.plans import baskets, forecast


def bought_of(spark, sales):
    return spark.createDataFrame([(k, x) for k, own in enumerate(sales) for x in own], "transaction_id long, item string")


def all_sets(sales, least, most):
    counts = Counter(s for own in sales for k in range(1, most + 1) for s in combinations(sorted(own), k))
    return {s: n for s, n in counts.items() if n >= least}


@pytest.mark.parametrize(("least", "most"), [(1, 4), (30, 4), (200, 3), (5000, 4)])
def test_frequent_sets_equal_counting(spark, least, most):
    random.seed(least)
    sales = [set(random.sample("abcdefgh", random.choice([1, 1, 2, 3, 5]))) for _ in range(700)]
    found, _ = baskets.frequent_sets(bought_of(spark, sales), least, most)
    assert found == all_sets(sales, least, most)


def test_baskets_over_several_ranges_and_huge_ones(spark, monkeypatch):
    monkeypatch.setattr(baskets, "CANDIDATES_AT_ONCE", 7)
    random.seed(4)
    # numbers beyond one bitmap, and a basket that holds two thousand items
    sales = [{random.choice("abc"), random.choice("abc"), random.choice("xyz")} for _ in range(40_000)]
    huge = {f"i{k}" for k in range(2000)} | set("abcxyz")
    found, _ = baskets.frequent_sets(bought_of(spark, [*sales, huge]), 500, 4)
    assert found == all_sets([*sales, set("abcxyz")], 500, 4)


def shop_of(spark, sales):
    """A shop of the given sales: (day, {product: units})."""
    shop = small_shop(spark)
    products = sorted({p for _, own in sales for p in own})
    rows = [(p, 1, 1, f"p{p}", None, None, D("1.00"), 0, 0, True, NOW, NOW) for p in products]
    heads = [(k, None, datetime.combine(day, datetime.min.time()), "cash", None, NOW) for k, (day, _) in enumerate(sales)]
    lines = [(k, p, n) for k, (_, own) in enumerate(sales) for p, n in own.items()]
    items = [(j, k, p, n, D("1.00")) for j, (k, p, n) in enumerate(lines)]
    return shop.replace(
        products=spark.createDataFrame(rows, shop.products.schema),
        transactions=spark.createDataFrame(heads, shop.transactions.schema),
        transaction_items=spark.createDataFrame(items, shop.transaction_items.schema),
    )


def test_rules_come_from_closed_sets(spark):
    day = date(2025, 1, 6)
    sales = [(day, dict.fromkeys(own, 1)) for own in [(1, 2, 3)] * 4 + [(1, 2)] * 0 + [(1,)] * 2 + [(4, 5)] * 3 + [(4,)]]
    found = {(r["items"], r["also"]): r for r in baskets.basket_rules(shop_of(spark, sales), "name", 0.2).collect()}
    # 1 + 2 never goes without 3, so only the three together give rules
    assert set(found) == {("p1 + p2", "p3"), ("p1 + p3", "p2"), ("p2 + p3", "p1"), ("p4", "p5"), ("p5", "p4")}
    assert (found["p4", "p5"].confidence, found["p4", "p5"].lift, found["p4", "p5"].n_both) == (0.75, 2.5, 3)
    assert (found["p2 + p3", "p1"].confidence, found["p2 + p3", "p1"].lift) == (1.0, round(10 / 6, 6))
    few = baskets.basket_rules(shop_of(spark, sales), "name", 0.2, min_confidence=0.8).collect()
    assert {(r["items"], r["also"]) for r in few} == set(found) - {("p4", "p5")}


def plain_forecast(units, weeks, held):
    """The fold in plain Python, with the shop's month factors already in ``weeks`` as (units, factor)."""
    learn = [x / f for x, f in weeks[: len(weeks) - held]]
    there = [x for x in learn if x > 0]
    chance, size, squares = len(there) / len(learn), sum(there) / max(1, len(there)), 0.0
    for x in learn:
        squares += (x - chance * size) ** 2
        chance, size = chance + 0.1 * ((x > 0) - chance), size + 0.1 * (x - size) if x > 0 else size
    level, sigma = chance * size, math.sqrt(squares / len(learn))
    errors = [abs(x - level * f) for x, f in weeks[len(weeks) - held :]]
    point = math.ceil(round(level * 2 + 1.65 * sigma * math.sqrt(2), 6))
    return round(level, 6), round(sigma, 6), round(sum(errors) / held, 6), point


def test_forecast_equals_plain_fold(spark):
    random.seed(8)
    monday = date(2024, 1, 1)
    n = 60
    demand = {1: [random.choice([0, 0, 3, 5]) for _ in range(n)], 2: [10 + k % 3 for k in range(n)], 3: [0] * n}
    demand[3][5] = 7
    # product 4 only sells in the weeks that are held out
    demand[4] = [0] * (n - 4) + [2, 0, 0, 2]
    sales = [(monday + timedelta(days=7 * w + w % 7), {p: own[w] for p, own in demand.items() if own[w]}) for w in range(n)]
    found = {r.product_id: r for r in forecast.demand_forecast(shop_of(spark, [s for s in sales if s[1]])).collect()}
    months = [(monday + timedelta(days=7 * w)).month for w in range(n)]
    totals = [sum(own[w] for own in demand.values()) for w in range(n - 4)]
    factor = {}
    for m in set(months[: n - 4]):
        own = [t for t, month in zip(totals, months) if month == m]
        factor[m] = (sum(own) * len(totals)) / (len(own) * sum(totals))
    for p, own in demand.items():
        weeks = [(x, factor.get(m, 1.0)) for x, m in zip(own, months)]
        r = found[p]
        assert (r.weekly, r.sigma, r.mean_error, r.reorder_point) == pytest.approx(plain_forecast(own, weeks, 4), abs=2e-6)
        assert r.units_held_out == sum(own[-4:])
        assert r.mean_error_flat == pytest.approx(sum(abs(x - sum(own[-8:-4]) / 4) for x in own[-4:]) / 4, abs=2e-6)
        assert r.suggested_units == max(0, r.reorder_point - r.on_hand)
    assert found[4].weekly == 0 and found[3].weekly < 0.5


def test_forecast_beats_a_flat_mean_on_seasonal_demand(spark):
    monday = date(2022, 1, 3)
    factor = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 3]
    sales = []
    for w in range(153):
        day = monday + timedelta(days=7 * w)
        # the weeks held out are the first of a December
        if day >= date(2024, 12, 29):
            break
        sales.append((day, {p: 10 * p * factor[day.month - 1] for p in (1, 2, 3)}))
    for r in forecast.demand_forecast(shop_of(spark, sales)).collect():
        assert r.mean_error < r.mean_error_flat / 2


def test_weeks_without_sales_are_no_rows(spark):
    """Products of any number meet their weeks without a row per product and week."""
    sales = [(date(2024, 1, 1) + timedelta(days=7 * k), {k % 3 + 1: 5}) for k in range(30)]
    plan = forecast.demand_forecast(shop_of(spark, sales))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
    assert "MapInArrow" in plan
