"""Dependencies, designs, references and spellings found in data, against plain Python."""

import random
from itertools import combinations

import pytest
from helpers import rows
from notebook import frames

from ledgerline.operators import components, inclusion, names
from ledgerline.operators.dependencies import discover
from ledgerline.plans import design


def plain_dependencies(table, columns, most):
    """Minimal dependencies and keys by counting every set of columns."""
    place = {c: k for k, c in enumerate(columns)}

    def distinct(names):
        return len({tuple(r[place[c]] for c in names) for r in table})

    found = set()
    for right in columns:
        minimal = []
        others = [c for c in columns if c != right]
        for size in range(most + 1):
            for left in combinations(others, size):
                if any(set(m) <= set(left) for m in minimal):
                    continue
                if distinct(left) == distinct((*left, right)):
                    minimal.append(left)
                    found.add((left, right, distinct(left)))
    keys = []
    for size in range(most + 1):
        for left in combinations(columns, size):
            if not any(set(k) <= set(left) for k in keys) and distinct(left) == len(table):
                keys.append(left)
    return found, set(keys)


def table_of(seed):
    random.seed(seed)
    towns = {t: random.choice("XY") for t in range(6)}
    out = []
    for n in range(random.choice([3, 40, 200])):
        town = random.randrange(6)
        out.append((n // 2, town, towns[town], random.choice([None, "a", ""]), random.choice([None, 0.5, 2.0]), "one"))
    return out + random.sample(out, min(2, len(out))) * (seed % 2)


NAMES = ("ref", "town", "area", "note", "price", "unit")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("sample_rows", [3, 2000])
def test_discovery_equals_counting(spark, seed, sample_rows):
    table = table_of(seed)
    df = spark.createDataFrame(table, "ref long, town int, area string, note string, price double, unit string")
    found = discover(df, max_left=3, sample_rows=sample_rows)
    expected, keys = plain_dependencies(table, NAMES, 3)
    assert {(d.left, d.right, d.n_values) for d in found.dependencies} == expected
    assert set(found.keys) == keys


def test_discovery_tells_nulls_apart_and_reads_empty_tables(spark):
    df = spark.createDataFrame([(None, "a", 1), ("a", None, 2)], "x string, y string, `z.z` int")
    found = discover(df)
    assert {(d.left, d.right) for d in found.dependencies} == {(a, b) for a in [("x",), ("y",), ("z.z",)] for b in ("x", "y", "z.z") if (b,) != a}
    empty = discover(df.limit(0))
    assert {(d.left, d.right) for d in empty.dependencies} == {((), c) for c in ("x", "y", "z.z")}
    assert empty.keys == ((),)


def design_of(columns, rules):
    return {(p.columns, p.key) for p in design.normal_form(columns.split(), rules)}


def test_normal_form_of_declared_rules():
    """The classic steps: partial and transitive dependencies leave, everything else stays."""
    rules = [(["a", "b"], "c"), (["a"], "d"), (["d"], "e"), (["a"], "e"), (["a", "b", "d"], "f")]
    assert design_of("a b c d e f", rules) == {
        (("a", "b", "c", "f"), ("a", "b")), (("a", "d"), ("a",)), (("d", "e"), ("d",)),
    }
    # two keys of one thing share a table; what nothing determines is part of the list's key
    assert design_of("a b c d", [(["a"], "b"), (["b"], "a"), (["b"], "c")]) == {
        (("a", "b", "c"), ("a",)), (("a", "d"), ("a", "d")),
    }
    assert design_of("a b", []) == {(("a", "b"), ("a", "b"))}
    assert design_of("a b", [([], "b")]) == {(("b",), ()), (("a",), ("a",))}


def test_sheet_of_products_gives_the_normalized_tables():
    """A price list, a sales list and a delivery log fall apart as their declared rules say."""
    inventory = (
        "product_name barcode category category_desc unit_code unit_label selling_price reorder_qty"
        " supplier_name supplier_contact supplier_phone supplier_address"
    )
    rules = [(["product_name"], c) for c in ("barcode", "category", "unit_code", "reorder_qty")]
    rules += [(["category"], "category_desc"), (["unit_code"], "unit_label"), (["product_name", "supplier_name"], "selling_price")]
    rules += [(["supplier_name"], c) for c in ("supplier_contact", "supplier_phone", "supplier_address")]
    assert design_of(inventory, rules) == {
        (("product_name", "barcode", "category", "unit_code", "reorder_qty"), ("product_name",)),
        (("category", "category_desc"), ("category",)),
        (("unit_code", "unit_label"), ("unit_code",)),
        (("product_name", "selling_price", "supplier_name"), ("product_name", "supplier_name")),
        (("supplier_name", "supplier_contact", "supplier_phone", "supplier_address"), ("supplier_name",)),
    }
    sales = "sale_id sale_date customer_name customer_phone payment_type line_no product_name quantity unit_price"
    rules = [(["sale_id"], c) for c in ("sale_date", "customer_name", "payment_type")]
    rules += [(["customer_name"], "customer_phone")]
    rules += [(["sale_id", "line_no"], c) for c in ("product_name", "quantity", "unit_price")]
    assert {key for _, key in design_of(sales, rules)} == {("sale_id",), ("customer_name",), ("sale_id", "line_no")}


def test_design_joins_back(spark):
    inventory, _, _ = frames(spark)
    random.seed(5)
    wide = [(n, n % 7, f"c{n % 7 % 3}", random.choice([None, "u", "v"]), n // 2, None) for n in range(60)]
    lists = [
        inventory.drop("alt_suppliers"),
        spark.createDataFrame([*wide, *wide[:5]], "id long, town int, area string, unit string, page int, note string"),
        spark.createDataFrame([(1, None, 2), (None, 1, 2), (1, 1, 2)], "a int, b int, c int"),
    ]
    for df in lists:
        parts = design.found_design(df)
        back = design.recompose(parts, design.decompose(df, parts)).select(*df.columns)
        assert rows(back) == rows(df.distinct()), parts
        # every table's key identifies its rows
        for part, table in zip(parts, design.decompose(df, parts), strict=True):
            assert table.count() == (table.select(*part.key).distinct().count() if part.key else 1)


def test_inclusions_equal_sets(spark):
    random.seed(2)
    tables = {
        "a": spark.createDataFrame([(k % 10, f"n{k % 4}", None) for k in range(30)], "id long, name string, gone int"),
        "b": spark.createDataFrame([(k, f"n{k}", float(k)) for k in range(12)], "id int, name string, price double"),
        "c": spark.createDataFrame([(3, [1], None), (None, None, "n1")], "id short, list array<int>, name string"),
    }
    values = {
        (t, f.name): (inclusion.kind_of(f.dataType), [r[0] for r in df.select(f.name).collect() if r[0] is not None])
        for t, df in tables.items()
        for f in df.schema.fields
        if inclusion.kind_of(f.dataType)
    }
    expected = []
    for (t, c), (kind, own) in values.items():
        for (u, d), (other, there) in values.items():
            found = set(own) & set(there)
            if (t, c) != (u, d) and kind == other and found and len(found) * 100 >= len(set(own)) * 90:
                expected.append((t, c, u, d, len(set(own)), len(found), len(set(there)) == len(there)))
    assert rows(inclusion.inclusions(tables)) == sorted(expected, key=repr)


def test_inclusions_with_more_columns_than_a_word(spark):
    df = spark.range(5).selectExpr(*[f"id + {k} AS c{k}" for k in range(70)])
    found = rows(inclusion.inclusions({"t": df}, min_coverage=100))
    assert found == []
    found = rows(inclusion.inclusions({"t": df}, min_coverage=80))
    assert len(found) == 2 * 69 and all(r[4:] == (5, 4, True) for r in found)


def edit_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_links_connect_what_pairs_connect(spark, distance):
    random.seed(distance)
    words = {"", "a", "ab", "ba"} | {"".join(random.choices("abc", k=random.randint(1, 7))) for _ in range(150)}
    words |= {"oatmeal", "oatmael", "oat meal", "oatmeals"}
    df = spark.createDataFrame([(w, w, "") for w in words], "name string, letters string, numbers string")
    linked = names.links(df, distance)
    pairs = {(r.a, r.b) for r in linked.collect()}
    assert all(edit_distance(a, b) <= distance for a, b in pairs)
    parent = {w: w for w in words}

    def find(w):
        while parent[w] != w:
            w = parent[w]
        return w

    for a, b in combinations(sorted(words), 2):
        if edit_distance(a, b) <= distance:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    found = {r.node: r.label for r in components.components(linked).collect()}
    assert {w: find(w) for w in words if w in found or find(w) != w} == found


def test_clusters(spark):
    typed = ["Milk 1l"] * 3 + ["milk  1L ", "Mlk 1l", "Milk 2l", "Mil 2l", "Mil 2l", "Salt", None, None, "SALT"]
    df = spark.createDataFrame([(t,) for t in typed], "name string")
    assert rows(names.clusters(df, "name")) == sorted(
        [
            ("Milk 1l", 3, "Milk 1l", 3), ("milk  1L ", 1, "Milk 1l", 3), ("Mlk 1l", 1, "Milk 1l", 3),
            ("Milk 2l", 1, "Mil 2l", 2), ("Mil 2l", 2, "Mil 2l", 2), ("Salt", 1, "SALT", 2), ("SALT", 1, "SALT", 2),
        ],
        key=repr,
    )
    assert rows(names.clusters(df.limit(0), "name")) == []


def test_discovery_tests_on_all_rows_only_what_samples_leave_open(spark, monkeypatch):
    """Rows counted over the whole table: sets that hold, not sets that a few classes refute."""
    from ledgerline.operators import dependencies

    counted, count = [], dependencies._counted

    def counting(codes, tests):
        counted.extend(tests)
        return count(codes, tests)

    monkeypatch.setattr(dependencies, "_counted", counting)
    random.seed(9)
    table = [(n, n % 97, n % 97 // 10, random.randrange(60), random.randrange(60)) for n in range(4000)]
    df = spark.createDataFrame(table, "id long, town int, area int, x int, y int")
    found = discover(df, max_left=2, sample_rows=1)
    expected, keys = plain_dependencies(table, ["id", "town", "area", "x", "y"], 2)
    assert {(d.left, d.right, d.n_values) for d in found.dependencies} == expected
    assert set(found.keys) == keys
    assert {left for left, _ in counted} == {(0,), (1,)}


@pytest.mark.parametrize("hot", [False, True])
def test_sets_with_a_common_column_share_a_shuffle(spark, monkeypatch, hot):
    from ledgerline.operators import dependencies

    dealt, deal = [], dependencies._Rows.dealt

    def dealing(self, columns, keys):
        dealt.append(tuple(keys))
        return deal(self, columns, keys)

    monkeypatch.setattr(dependencies._Rows, "dealt", dealing)
    if hot:
        monkeypatch.setattr(dependencies._Rows, "_even", lambda self, column: False)
    random.seed(3)
    table = [(k // 2, (k // 2) % 30, *[random.randrange(40) for _ in range(5)]) for k in range(600)]
    df = spark.createDataFrame(table, "id long, town int, u int, v int, x int, y int, z int")
    found = discover(df, max_left=3)
    expected, keys = plain_dependencies(table, df.columns, 3)
    assert {(d.left, d.right, d.n_values) for d in found.dependencies} == expected
    assert set(found.keys) == keys
    assert bool(dealt) != hot


def test_names_with_rare_numbers_take_no_patterns(spark, monkeypatch):
    kept, stored = {}, names.materialize

    def storing(df, label):
        out = stored(df, label)
        kept[label] = out.count()
        return out

    monkeypatch.setattr(names, "materialize", storing)
    typed = [f"Customer {k}" for k in range(200)] + [f"Custmer {k}" for k in range(100)] + ["milk", "mlk", "mik"] * 2
    df = spark.createDataFrame([(t,) for t in typed], "name string")
    found = {r.name: (r.cluster, r.n_names) for r in names.clusters(df, "name").collect()}
    assert found["Custmer 7"] == ("Custmer 7", 2) and found["Customer 107"] == ("Customer 107", 1)
    assert found["mik"] == ("mik", 3)
    assert kept["patterns"] == 0
