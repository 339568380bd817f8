"""Line rules, near-duplicate groups and the classifier against plain Python."""

import random

import pytest
from plain import awkward, base_counts, docs, groups

from ledgerline.llm import line_rules, near_dups, quality_model
from ledgerline.operators.components import components

CLASH = ("n_words", "kept", "key", "cls", "score", "host", "line")


def test_base_counts_equal_plain_python(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [*[tuple(r) for r in table.collect()], *awkward()]
    found = line_rules.judge(docs(spark, rows, CLASH)).collect()
    assert len(found) == len(rows)
    expected = sorted((str(r[0]), sorted(base_counts(r[1]).items())) for r in rows)
    assert sorted((str(r.doc_id), sorted((c, r[c]) for c in line_rules.COUNTS)) for r in found) == expected
    for row in found:
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.base_failed == failed and not (failed and row.kept)


def test_frequent_lines_are_taken_out(spark):
    own = ["alpha beta gamma delta %d epsilon zeta eta theta iota kappa lambda %d" % (k, k) for k in range(60)]
    menu = "Home | Products | About us | Contact | Legal notice | Press | Jobs today"
    rows = [(k, f"{menu}\n{own[k]} mu nu xi omicron", "en", "a", 0) for k in range(30)]
    # mostly menu; the other words are too few
    rows += [(100 + k, f"{menu}  \n{menu.upper()}\nx{k} y", "en", "a", 0) for k in range(5)]
    # copies of one document agree in their other lines, so their lines are no boilerplate
    lines = "\n".join(" ".join(f"w{j}{k}" for k in range(9)) for j in range(3))
    rows += [(200 + k, lines, "en", "b", 0) for k in range(40)]
    found = {r.doc_id: r for r in line_rules.judge(docs(spark, rows), min_documents=20, host_percent=10).collect()}
    assert all(found[k].kept and found[k].boilerplate_words > 0 for k in range(30))
    assert not any(found[100 + k].kept for k in range(5))
    assert all(found[200 + k].kept and found[200 + k].boilerplate_words == 0 for k in range(40))


def test_documents_that_share_several_lines_count(spark):
    header, disclaimer = " ".join(f"h{k}" for k in range(12)), " ".join(f"d{k}" for k in range(50))
    rows = [(k, f"{header}\n{' '.join(f'own{k}x{j}' for j in range(8))}\n{disclaimer}", "en", "a", 0) for k in range(30)]
    # the lines of one document in another order, and again, are a copy of it
    rows += [(100 + k, f"{disclaimer}\nown text of one document\n{header}\n" + f"{header}\n" * (k % 2), "en", "b", 0) for k in range(30)]
    # copies do not lower the share of the other documents that have a line
    menu = "Home | Products | About us | Contact | Legal notice | Press | Jobs today"
    rows += [(200 + k, f"{menu}\n{' '.join(f'w{k}x{j}' for j in range(40))}", "en", "c", 0) for k in range(25)]
    rows += [(300 + k, " ".join(f"same{j}" for j in range(20)), "en", "c", 0) for k in range(300)]
    found = {r.doc_id: r for r in line_rules.judge(docs(spark, rows), min_documents=20, host_percent=10).collect()}
    assert all(found[k].boilerplate_words == 62 and not found[k].kept for k in range(30))
    assert all(found[100 + k].boilerplate_words == 0 for k in range(30))
    assert all(found[200 + k].boilerplate_words == len(menu.split()) and found[200 + k].kept for k in range(25))
    assert all(found[300 + k].boilerplate_words == 0 and found[300 + k].kept for k in range(300))


def family(start, seed, edit_words):
    """Sixty documents of eight lines, each with one line edited."""
    random.seed(seed)
    lines = [" ".join(f"f{seed}x{j}y{k}" for k in range(11)) for j in range(8)]
    out = []
    for k in range(60):
        own, at = list(lines), random.randrange(8)
        own[at] = " ".join([*own[at].split()[edit_words:], *[f"e{k}x{j}" for j in range(edit_words)]])
        out.append((start + k, "\n".join(own), "en", "a", 0))
    return out


def test_a_family_of_edited_copies_does_not_vanish(spark):
    rows = [(k, "\n".join(" ".join(f"o{k}x{j}y{i}" for i in range(9)) for j in range(4)), "en", "a", 0) for k in range(1000)]
    rows += family(2000, 1, 1) + family(3000, 2, 11)
    found = {r.doc_id: r for r in line_rules.judge(docs(spark, rows)).collect()}
    assert all(found[k].kept for k in range(1000))
    for start in (2000, 3000):
        kept = [k for k in range(start, start + 60) if found[k].kept]
        assert 1 <= len(kept) <= 8 and start in kept
        text = {k: set(t.split("\n")) for k, t, *_ in rows if start <= k < start + 60}
        # every line that the family shares is still there
        shared = {line for own in text.values() for line in own if sum(line in other for other in text.values()) > 20}
        assert shared and shared <= set().union(*[text[k] for k in kept])
        again = line_rules.judge(docs(spark, rows).repartition(7)).filter("kept").collect()
        assert sorted(r.doc_id for r in again if start <= r.doc_id < start + 60) == kept
    # a menu that passing documents have needs nobody to stand for it
    menu = "Home | Products | About us | Contact | Legal notice | Press | Jobs today | Help"
    pages = [(k, f"{menu}\n{' '.join(f'w{k}x{j}' for j in range(40))}", "en", "b", 0) for k in range(40)]
    pages += [(100 + k, f"{menu}\nx{k} y", "en", "b", 0) for k in range(3)]
    found = {r.doc_id: r for r in line_rules.judge(docs(spark, pages), 20, 10).collect()}
    assert all(found[k].kept for k in range(40)) and not any(found[100 + k].kept for k in range(3))


def test_rules_keep_columns_and_rows(spark):
    table = docs(spark, awkward(), CLASH)
    kept = line_rules.keep_good(table)
    assert kept.columns == table.columns
    judged = line_rules.judge(table).filter("kept").count()
    assert kept.count() == judged
    assert line_rules.keep_good(table.limit(0)).count() == 0


def near_copies(seed, base_words, copies, edits):
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(base_words)]
    out = [" ".join(base)]
    for _ in range(copies):
        text = list(base)
        for _ in range(random.randrange(edits)):
            text[random.randrange(len(text))] = f"e{random.randrange(50)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80), (3, 60)])
def test_groups_equal_all_pairs(spark, size, percent):
    texts = [*near_copies(1, 60, 60, 12), *near_copies(2, 300, 30, 40), *near_copies(3, 9, 20, 3)]
    texts += [r[1] for r in awkward()]
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(texts)]
    expected, sets = groups(texts, size, percent)
    found = near_dups.groups(docs(spark, rows, CLASH), size, percent).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == expected[row.doc_id], texts[row.doc_id][:80]
        assert row.kept == (row.doc_id == row.component_id)


def test_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 3)
    texts = near_copies(5, 60, 80, 16)
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(texts)]
    found = near_dups.groups(docs(spark, rows), 2, 80).collect()
    expected, _ = groups(texts, 2, 80)
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(expected))


def test_one_of_a_group_stays(spark):
    table = docs(spark, awkward(), CLASH)
    kept = near_dups.keep_one(table)
    assert kept.columns == table.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # texts without words are linked with nothing; "one" and "One" are one text; row 3 is repeated
    assert ids == sorted([0, 1, 2, 3, 5, 6, 8, 9, 10, 12, 13, None, None], key=str)
    assert near_dups.keep_one(table.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classifier_on_held_out_labels(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_model.train(table, labels)
    scored = quality_model.score(table, model)
    assert scored.count() == table.count()
    held = scored.filter("held_out").join(labels, "doc_id").toPandas()
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() >= 0.95
    again = quality_model.train(table.repartition(7), labels.repartition(3))
    assert again[1] == model[1] and (again[0] == model[0]).all()


def test_classifier_on_awkward_rows(spark):
    table = docs(spark, awkward(), CLASH)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (3, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_model.train(table, labels)
    rows = quality_model.score(table, model).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    empty = quality_model.train(table, labels.limit(0))
    assert all(r.score == 0.5 for r in quality_model.score(table, empty).collect())
    kept = quality_model.keep_good(table, model, 0.0)
    assert kept.columns == table.columns and kept.count() == len(awkward())
    assert quality_model.score(table.limit(0), model).count() == 0


def test_classifier_sample_is_bounded(spark):
    rows = [(k, "good words here " * 20 if k % 2 else "bad### " * 30, "en", "a", 0) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    model = quality_model.train(docs(spark, rows), labels, documents=40, chars=8000)
    scored = {r.doc_id: r.predicted for r in quality_model.score(docs(spark, rows), model, 0.5).collect()}
    assert scored == {k: k % 2 for k in range(200)}


def test_classifier_sample_takes_one_row_of_an_id(spark):
    """An id with very many rows, labels that are no labels, and texts of one size beyond the limit."""
    table = docs(spark, [(0, f"good words number {k} here", "en", "a", 0) for k in range(5000)])
    more = docs(spark, [(k, ("good words here " if k % 2 else "bad### one ") * 20, "en", "a", 0) for k in range(1, 60)])
    labels = [(k, k % 2, 0) for k in range(60)] + [(2, 2, 0), (61, -1, 0), (3, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_model.train(table.unionByName(more), labels, documents=50, chars=3000)
    assert model[0].shape == (quality_model.BUCKETS,) and abs(model[1]) < 100
    again = quality_model.train(more.unionByName(table).repartition(5), labels, documents=50, chars=3000)
    assert again[1] == model[1] and (again[0] == model[0]).all()
    scored = quality_model.score(more, model, 0.5).collect()
    assert all(0 <= r.score <= 1 for r in scored)


def test_one_of_a_group_stays_without_ids(spark):
    """Near copies that have no id, or one id between them, are one group like any other."""
    copies = near_copies(8, 80, 3, 2)
    rows = [(None, text, "en", "a", 0) for text in copies] + [(7, text.upper() + " end", "en", "a", 0) for text in copies]
    rows += [(9, "another text of its own entirely", "en", "a", 0), (None, None, "en", "a", 0)]
    kept = near_dups.keep_one(docs(spark, rows)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([7, 9, None], key=str)
    grouped = near_dups.groups(docs(spark, rows)).collect()
    # repeated rows are one document
    assert len({(r.key, r.check) for r in grouped if r.chosen}) == 3
    assert all(r.chosen for r in grouped if not r.n_shingles)
