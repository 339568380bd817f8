"""CSV exchange, publishing and the change stream."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import rows
from ledgerline.functions import money, text
from ledgerline.model import TABLES
from ledgerline.operators import changes
from ledgerline.sources import csv, publish
from ledgerline.streaming import stock
from shops import small_shop


def test_csv_roundtrip_of_all_tables(spark, tmp_path):
    shop = small_shop(spark)
    csv.write_tables(shop.tables(), str(tmp_path))
    back = csv.read_tables(spark, str(tmp_path))
    for name, df in shop.tables():
        assert back[name].schema == df.schema, name
        assert rows(back[name]) == rows(df), name


def test_csv_columns_in_any_order_and_defaults(spark, tmp_path):
    path = str(tmp_path / "products")
    df = spark.createDataFrame([("Flour", 1, "20.00")], "name string, product_id long, current_price string")
    csv.write_csv(df, path)
    table = TABLES["products"]
    back = csv.with_defaults(csv.read_csv(spark, path, table.schema), table)
    assert back.columns == table.columns
    row = back.first()
    assert (row.product_id, row.current_price, row.reorder_level, row.is_active) == (
        1, D("20.00"), 0, True,
    )
    assert row.created_at is not None and row.barcode is None


def test_csv_rejects_unknown_columns_and_bad_values(spark, tmp_path):
    path = str(tmp_path / "bad")
    csv.write_csv(spark.createDataFrame([("x",)], "surprise string"), path)
    with pytest.raises(ValueError, match="surprise"):
        csv.read_csv(spark, path, TABLES["units"].schema)
    path = str(tmp_path / "worse")
    csv.write_csv(spark.createDataFrame([("one", "pc")], "unit_id string, code string"), path)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv.read_csv(spark, path, TABLES["units"].schema).collect()


def test_fill_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, n int")
    assert rows(csv.fill_defaults(df, {"n": 0})) == [(1, 0), (2, 5)]


def test_publish_and_read_back(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    first = publish.publish(small_shop(spark), root)
    shop = publish.read_published(spark, root)
    # the stored count was recomputed from the lines
    assert rows(shop.products, "product_id", "stock_on_hand") == [(1, -4), (2, 28), (3, 0)]
    second = publish.publish(small_shop(spark), root)
    assert publish.current_version(spark, root) == (second, 2) and first != second
    again = publish.read_published(spark, root)
    for name, df in shop.tables():
        assert rows(getattr(again, name)) == rows(df), name


def test_a_failed_load_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(small_shop(spark), root)
    before = publish.current_version(spark, root)
    shop = small_shop(spark)
    bad = shop.replace(
        transaction_items=shop.transaction_items.withColumn("product_id", F.lit(99).cast("bigint"))
    )
    with pytest.raises(publish.ValidationError, match="transaction_items reference:product_id: 1"):
        publish.publish(bad, root)
    assert publish.current_version(spark, root) == before


def feed(spark, path, batch, rows_):
    schema = (
        "change_id long, side string, op string, product_id long, quantity int,"
        " new_product_id long, new_quantity int"
    )
    spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_counts_every_change_once(spark, tmp_path):
    source, deltas, mark = (str(tmp_path / n) for n in ("source", "deltas", "mark"))
    first = [(1, "restock", "INSERT", 1, 10, None, None), (2, "sale", "INSERT", 1, 3, None, None)]
    # change 2 is delivered again, together with a change of product
    second = [(2, "sale", "INSERT", 1, 3, None, None), (3, "sale", "UPDATE", 1, 3, 2, 4)]
    schema = "change_id long, side string, op string, product_id long, quantity int, new_product_id long, new_quantity int"
    for part in (first, second):
        feed(spark, source, 0, part)
        stream = spark.readStream.schema(schema).parquet(source)
        stock.stock_stream(stream, deltas, mark).awaitTermination()
    assert rows(stock.current_totals(spark, "product_id", deltas, "d")) == [(1, 10), (2, -4)]
    # a batch that runs again replaces its own folder
    batches = spark.read.parquet(deltas).select("batch_id").distinct().count()
    assert batches == 2
    folded = str(tmp_path / "folded")
    assert stock.compact(spark, "product_id", deltas, folded, mark) == 1
    assert rows(stock.current_totals(spark, "product_id", folded, "d")) == [(1, 10), (2, -4)]
    # and the stream goes on in the folded place
    feed(spark, source, 0, [(4, "restock", "INSERT", 2, 6, None, None)])
    stream = spark.readStream.schema(schema).parquet(source)
    stock.stock_stream(stream, folded, mark).awaitTermination()
    assert rows(stock.current_totals(spark, "product_id", folded, "d")) == [(1, 10), (2, 2)]


def test_compaction_leaves_uncommitted_batches_alone(spark, tmp_path):
    source, deltas, mark, folded = (str(tmp_path / n) for n in ("source", "deltas", "mark", "folded"))
    schema = "change_id long, side string, op string, product_id long, quantity int, new_product_id long, new_quantity int"
    for change in (1, 2):
        feed(spark, source, 0, [(change, "restock", "INSERT", 1, 10, None, None)])
        stock.stock_stream(spark.readStream.schema(schema).parquet(source), deltas, mark).awaitTermination()
    # the second batch was written, but the stream ended before it was committed
    for name in ("1", ".1.crc"):
        (tmp_path / "mark" / "commits" / name).unlink(missing_ok=True)
    assert stock.last_committed(spark, mark) == 0
    assert stock.compact(spark, "product_id", deltas, folded, mark) == 0
    assert rows(stock.current_totals(spark, "product_id", folded, "d")) == [(1, 20)]
    stock.stock_stream(spark.readStream.schema(schema).parquet(source), folded, mark).awaitTermination()
    assert rows(stock.current_totals(spark, "product_id", folded, "d")) == [(1, 20)]


TEXTS = ["  lead", "trail  ", "", None, 'say "hi", now', '""', "back\\slash", '\\"', "a,b", "'", "#x", "\t"]


def test_csv_text_in_both_directions(spark, tmp_path):
    import csv as standard

    schema = StructType.fromDDL("n BIGINT, t STRING")
    for multi_line, texts in ((False, TEXTS), (True, [*TEXTS, "a\nb", "c\r\nd", "e\rf", "\n", 'x\n"y"\n'])):
        path = str(tmp_path / f"out{multi_line}")
        wanted = sorted(enumerate(texts))
        csv.write_csv(spark.createDataFrame(wanted, schema), path, multi_line)
        assert sorted(tuple(r) for r in csv.read_csv(spark, path, schema, multi_line).collect()) == wanted
        # what is written is read by a standard reader
        found = []
        for part in (tmp_path / f"out{multi_line}").glob("part-*"):
            with open(part, newline="") as file:
                found += [(int(r["n"]), r["t"]) for r in standard.DictReader(file)]
        assert sorted(found) == [(n, t or "") for n, t in wanted]
        # and the other way round; a standard writer has no sign for NULL
        folder = tmp_path / f"in{multi_line}"
        folder.mkdir()
        with open(folder / "a.csv", "w", newline="") as file:
            writer = standard.writer(file, lineterminator="\n")
            writer.writerow(["n", "t"])
            writer.writerows(wanted)
        back = sorted(tuple(r) for r in csv.read_csv(spark, str(folder), schema, multi_line).collect())
        assert [(n, t or "") for n, t in back] == [(n, t or "") for n, t in wanted]


def test_line_breaks_need_multi_line(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\rb")], "n long, t string")
    with pytest.raises(Exception, match="line break"):
        csv.write_csv(df, str(tmp_path / "x"))


def test_two_publishers_cannot_take_one_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish.publish(small_shop(spark), root)
    # both have read the same last version
    monkeypatch.setattr(publish, "current_version", lambda *_: None)
    with pytest.raises(publish.ConflictError, match="number 1"):
        publish.publish(small_shop(spark), root)


def test_a_dead_publisher_is_taken_over(spark, tmp_path):
    root = str(tmp_path)
    # a load that claimed the first number and died
    publish._claim(spark, root, 1, stale_after=3600)
    with pytest.raises(publish.ConflictError, match="number 1"):
        publish.publish(small_shop(spark), root)
    version = publish.publish(small_shop(spark), root, stale_after=0)
    assert publish.current_version(spark, root) == (version, 1)
    # had it only been slow, it would notice
    assert not publish._still_held(spark, f"{root}/claims/1-0") and publish._still_held(spark, f"{root}/claims/1-1")


def test_old_and_failed_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    names = [publish.publish(small_shop(spark), root) for _ in range(3)]
    shop = small_shop(spark)
    with pytest.raises(publish.ValidationError):
        publish.publish(shop.replace(customers=shop.customers.unionByName(shop.customers)), root)
    folders = lambda: sorted(p.name for p in (tmp_path / "versions").iterdir())
    assert folders() == sorted(names)
    (tmp_path / "versions" / "never-finished").mkdir()
    assert publish.prune(spark, root, keep=2) == []
    assert publish.prune(spark, root, keep=2, stale_after=0) == sorted([names[0], "never-finished"])
    assert folders() == sorted(names[1:])
    assert rows(publish.read_published(spark, root).units) == rows(shop.units)


def test_stream_equals_batch_for_a_folder_source(spark, tmp_path, sf_dir):
    from ledgerline.catalog import QUERIES
    from ledgerline.sources import tables

    events = tables.read_table(spark, sf_dir, "events")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["stock_stream"](spark, str(tmp_path))
    batch = changes.net_stock(changes.stock_deltas(tables.stock_changes_of(events)))
    assert rows(got) == rows(batch)


def test_expressions(spark):
    df = spark.createDataFrame(
        [(D("10.13"), 7, "a\nb\r\nc"), (D("0.01"), 123456, "x")], "p decimal(10,2), n long, t string"
    )
    got = rows(
        df.select(
            money.round_quarter("p"),
            money.money(money.cents("p")),
            text.barcode(F.col("n")),
            text.document_no(F.col("n")),
            text.one_line(F.col("t")),
        )
    )
    assert got == [
        (D("0.25"), D("0.01"), "4800000123456", "DR-123456", "x"),
        (D("10.25"), D("10.13"), "4800000000007", "DR-000007", "a, b, c"),
    ]


def test_cost_uses_the_default_markup_for_unknown_groups(spark):
    df = spark.createDataFrame([(D("118.00"), None), (D("900.90"), D("1.12"))], "p decimal(10,2), m decimal(4,2)")
    assert rows(df.select(money.cost_from_price("p", "m"))) == [(D("100.00"),), (D("804.37"),)]
