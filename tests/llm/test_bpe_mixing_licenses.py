"""Tokens, mixing and license scans against plain Python and public tokenizers."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import awkward, docs, words

from ledgerline.llm import bpe, licenses, mixing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CLASH = ("n_tokens", "ids", "bytes", "size", "copies", "target", "level", "license", "words", "index")


def encoding():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )


def digest(values):
    return hashlib.sha256(values).hexdigest()


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    rows = [*awkward(), (900, "x" * 3000 + " " * 500 + "\t\n<|endoftext|> 123456789 don't we'll", "en", "a", 0)]
    found = bpe.round_trip(docs(spark, rows, CLASH), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    library = encoding()
    expected = []
    for doc_id, text, *_ in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        expected.append((str(doc_id), len(ids) // 4, digest(ids), digest((text or "").encode())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(expected)
    assert all(digest(bytes(r.token_ids)) == r.ids_sha256 for r in found)


def test_tokens_of_the_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    library = encoding()
    expected = {r.doc_id: len(library.encode_ordinary(r.text)) for r in table.collect()}
    found = bpe.round_trip(table, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.n_tokens for r in found} == expected
    assert bpe.round_trip(table.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_words_folded_by_higher_order_functions(spark):
    library = encoding()
    sample = ["the", " unbelievable", "é", "🙂", "zzzz", "  ", "a", " don", "Ünïcödé", "x" * 40]
    table = spark.createDataFrame([(sample,)], "words array<string>")
    found = table.select(bpe.encode_words(table.words, RANKS).alias("ids")).first().ids
    assert found == [library.encode_ordinary(word) for word in sample]


def fill(sizes, weights=(5, 2, 1), total=1.5, most=2):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, rest, open_ = dict.fromkeys(order, 0.0), total * sum(sizes.values()), [s for s in order if sizes[s]]
    while open_ and rest > 1e-9:
        share = rest / sum(weight[s] for s in open_)
        for s in open_:
            target[s] += share * weight[s]
        rest = sum(max(0, target[s] - most * sizes[s]) for s in open_)
        target = {s: min(t, most * sizes[s]) for s, t in target.items()}
        open_ = [s for s in open_ if target[s] < most * sizes[s] - 1e-9]
    return target


def mixture(spark):
    rows = [(k, "w " * (1 + k % 37), "en", ["a", "b", "c", "d", None][min(k % 9, 4)], 0) for k in range(900)]
    return [*rows, (900, None, "en", "empty", 0), (901, "", "en", "empty", 0), (902, "w " * 5000, "en", "b", 0)]


@pytest.mark.parametrize("awkward_rows", [False, True])
def test_mix_meets_its_targets(spark, awkward_rows):
    rows = awkward() if awkward_rows else mixture(spark)
    found = mixing.mix(docs(spark, rows, CLASH)).collect()
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    goals = fill(sizes)
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in rows}
    taken, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for row in found:
        source = by_id[row.doc_id][3]
        if row.doc_id is not None:
            assert row.size == len(words(by_id[row.doc_id][1]))
        if row.doc_id is None:
            continue
        assert row.source_size == sizes[source] and abs(row.target - goals[source]) < 1e-6
        assert row.taken == row.copies * row.size <= 2 * row.size
    assert sorted((r.size, r.taken) for r in found) == sorted(
        (r.size, r.taken) for r in mixing.mix(docs(spark, rows).repartition(5)).collect()
    )
    if not awkward_rows:
        for row in found:
            source = by_id[row.doc_id][3]
            taken[source] += row.taken
            longest[source] = max(longest[source], row.size)
        assert all(abs(taken[s] - goals[s]) <= longest[s] for s in sizes)


def test_mix_repeats_rows(spark):
    table = docs(spark, mixture(spark), CLASH)
    copies = {r.doc_id: r.copies for r in mixing.mix(table).collect()}
    taken = mixing.take_mix(table)
    assert taken.columns == table.columns
    counts = {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    assert counts == {k: c for k, c in copies.items() if c}
    assert mixing.take_mix(table.limit(0)).count() == 0 and mixing.mix(table.limit(0)).count() == 0


def test_mix_prefers(spark):
    table = docs(spark, [(k, "w " * 10, "en", "ab"[k % 2], 0) for k in range(2000)])
    table = table.selectExpr("*", "CAST(CASE WHEN doc_id % 4 < 2 THEN 4.0 ELSE 1.0 END AS DOUBLE) AS worth")
    found = mixing.mix(table, total=0.5, preference="worth").collect()
    much = sum(r.taken for r in found if r.doc_id % 4 < 2)
    little = sum(r.taken for r in found if r.doc_id % 4 >= 2)
    assert abs(much + little - 10_000) <= 20 and 3 < much / little < 5


def test_mix_draws_longer_documents_with_their_odds(spark):
    """Mean copies follow the wanted ones, which grow with the square root of the words up to two."""
    sizes = [16, 64, 256, 1024]
    rows = [(k, " ".join(["w"] * sizes[k % 4]), "en", "a", 0) for k in range(8000)]
    for total in (0.2, 1.0, 1.5):
        found = mixing.mix(docs(spark, rows), total=total).collect()
        words = sum(r.taken for r in found)
        assert abs(words - total * sum(r.size for r in found)) <= 1024
        mean = [sum(r.copies for r in found if r.size == s) / 2000 for s in sizes]
        # the level at which the wanted copies have the wanted words
        low, high = 0.0, 100.0
        for _ in range(60):
            level = (low + high) / 2
            wanted = [min(2.0, level * (s / 256) ** 0.5) for s in sizes]
            low, high = (low, level) if sum(w * s for w, s in zip(wanted, sizes)) > total * sum(sizes) else (level, high)
        assert all(abs(m - w) < 0.06 for m, w in zip(mean, wanted)), (total, mean, wanted)
        assert all({r.copies for r in found if r.size == s} <= {int(w), int(w) + 1, round(w)} for s, w in zip(sizes, wanted))


def test_rows_of_one_id_are_drawn_each_on_its_own(spark):
    """A source in which one id owns all rows, or one row is repeated, still comes near its target."""
    rows = [(5, " ".join([f"t{k}"] * (5 + k % 20)), "en", "a", 0) for k in range(300)]
    rows += [(6, "the same ten words in every one of these rows", "en", "b", 0)] * 400
    rows += [(None, f"none {k} has an id here", "en", "c", 0) for k in range(200)] + [(1, "alone and small", "en", None, 0)]
    table = docs(spark, rows, CLASH)
    found = mixing.mix(table).collect()
    assert len(found) == len(rows)
    for size in {r.source_size for r in found}:
        own = [r for r in found if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    again = mixing.mix(table.repartition(3)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    taken = mixing.take_mix(table)
    assert taken.columns == table.columns
    counted = {s: 0 for s in ("a", "b", "c", None)}
    for r in taken.collect():
        counted[r.source] += len(words(r.text))
    goals = {r.source_size: r.target for r in found}
    sizes = {s: sum(len(words(t)) for _, t, _, o, _ in rows if o == s) for s in counted}
    assert all(abs(counted[s] - goals[sizes[s]]) <= 25 for s in counted)


def brute_licenses(text, templates, least=0.8):
    """For every template, whether some stretch of its length holds the share of its shingles."""
    from plain import lower

    found = set()
    own = words(lower(text))
    for name, notice in templates.items():
        notice = words(lower(notice))
        size = min(5, len(notice))
        wanted = {tuple(notice[k : k + size]) for k in range(len(notice) - size + 1)}
        length = len(notice) - size + 1
        for k in range(max(0, len(own) - size + 1)):
            have = {tuple(own[j : j + size]) for j in range(k, min(k + length, len(own) - size + 1))}
            if len(wanted & have) >= least * len(wanted):
                found.add(name)
                break
    return found


def test_licenses_equal_brute_force(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    long = licenses.TEMPLATES["Apache-2.0 header"].split()
    edited = [*long[:20], "CHANGED", *long[21:]]
    texts += [
        "before it " * 40 + " ".join(long) + " after it" * 30, " ".join(edited), " ".join(long[:30]),
        "\n".join(licenses.TEMPLATES.values()).upper(), "x " * 7 + licenses.TEMPLATES["MIT"], "Released under the MIT", "",
    ]
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(texts)] + [(10_000, None, "en", "a", 0)]
    found = {}
    for row in licenses.scan(docs(spark, rows, CLASH)).collect():
        found.setdefault(row.doc_id, set()).add(row.license)
        match = texts[row.doc_id].encode()[row.first_byte : row.end_byte].decode()
        assert row.containment >= 0.8 and words(match)
    expected = {k: brute_licenses(text, licenses.TEMPLATES) for k, text in enumerate(texts)}
    # a window is an eighth longer than a template, so it may hold a little more
    for k in range(len(texts)):
        assert expected[k] <= found.get(k, set())
    assert sum(len(found.get(k, ())) - len(expected[k]) for k in range(len(texts))) <= 1
    assert licenses.scan(docs(spark, rows).limit(0)).count() == 0


def test_licenses_in_other_words_and_as_a_whole(spark):
    header, bsd = licenses.TEMPLATES["Apache-2.0 header"].split(), licenses.NOTICES["BSD-2-Clause text"]
    broken = [" ".join(header[k : k + 9]) for k in range(0, len(header), 9)]
    gnu = licenses.NOTICES["GPL-2.0 notice"]
    cases = {
        "Released under the MIT License, as is": {"MIT"},
        "\u00a9 x. (All rights reserved)": {"All rights reserved"},
        "All rights reserved": {"All rights reserved"},
        "# " + "\n# ".join(broken): {"Apache-2.0 header"},
        "/*\n * " + "\n * ".join(broken) + "\n */": {"Apache-2.0 header"},
        "//" + "\n//".join(broken): {"Apache-2.0 header"},
        bsd.replace('"AS IS"', "\u201cAS IS\u201d"): {"BSD-2-Clause text"},
        licenses.NOTICES["MIT text"]: {"MIT text"},
        licenses.NOTICES["MIT text"] + "\nReleased under the MIT License!": {"MIT text", "MIT"},
        gnu: {"GPL-2.0 notice"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        "-- " + licenses.NOTICES["LGPL-2.1 notice"]: {"LGPL-2.1 notice"},
        licenses.NOTICES["AGPL-3.0 notice"]: {"AGPL-3.0 notice"},
        licenses.NOTICES["ISC text"]: {"ISC text"},
        licenses.NOTICES["Unlicense"]: {"Unlicense"},
        licenses.NOTICES["MPL-2.0"]: {"MPL-2.0"},
        "Licensed under CC BY-ND 4.0": {"CC-BY-ND-4.0 short"},
        "Licensed under CC BY-NC 3.0, and the MIT License": set(),
    }
    cases |= {licenses.TEXTS[f"{name} text"]: {f"{name} text"} for name in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "CC0-1.0", "MPL-2.0")}
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(cases)]
    found = {k: set() for k in range(len(rows))}
    for row in licenses.scan(docs(spark, rows)).collect():
        found[row.doc_id].add(row.license)
    assert [found[k] for k in range(len(rows))] == list(cases.values())


def test_licenses_from_a_table(spark):
    table = spark.createDataFrame([("A", "one two three"), ("A", "six of seven"), ("B", None), (None, "x")], "license string, text string")
    templates = licenses.template_table(table)
    assert templates == {"A": "one two three", "A (2)": "six of seven"}
    rows = [(1, "zero, one two three!", "en", "a", 0)]
    assert [(r.license, r.containment) for r in licenses.scan(docs(spark, rows), templates).collect()] == [("A", 1.0)]


def test_identifiers(spark):
    cases = {
        "// SPDX-License-Identifier: MIT": {"MIT identifier"},
        "# SPDX-License-Identifier: GPL-2.0-or-later\nimport os": {"GPL-2.0-or-later identifier"},
        "/* SPDX-License-Identifier: (Apache-2.0 OR MIT) */": {"Apache-2.0 identifier"},
        "SPDX-License-Identifier: unknown": set(),
    }
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(cases)]
    found = {k: set() for k in range(len(rows))}
    for row in licenses.scan(docs(spark, rows)).collect():
        found[row.doc_id].add(row.license)
    assert [found[k] for k in range(len(rows))] == list(cases.values())


def test_bands_retrieve_what_is_there(spark):
    """A thousand templates; edited copies inside other words are found through bands, and only through bands."""
    random = np.random.Generator(np.random.PCG64(3))
    vocabulary = [f"w{k}" for k in range(3000)]

    def some(n):
        return [vocabulary[k] for k in random.integers(0, len(vocabulary), n)]

    templates = {f"t{k}": some(int(random.integers(12, 300))) for k in range(1000)}
    texts, planted = [], []
    for k in range(400):
        name = f"t{random.integers(0, 1000)}"
        own = list(templates[name])
        # the share of shingles that stay is between 0.8 and 1
        edits = int(random.integers(0, max(1, (len(own) - 4) // 25) + 1))
        for at in random.integers(0, len(own), edits):
            own[at] = "edited"
        texts.append(" ".join(some(int(random.integers(0, 400))) + own + some(int(random.integers(0, 400)))))
        size = licenses._shingle_size(len(own))
        had = {tuple(templates[name][j : j + size]) for j in range(len(own) - size + 1)}
        have = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)}
        planted.append((name, len(had & have) / len(had)))
    texts_of = {name: " ".join(own) for name, own in templates.items()}
    rows = [(k, text, "en", "a", 0) for k, text in enumerate(texts)]
    found = {}
    for row in licenses.scan(docs(spark, rows), texts_of).collect():
        found.setdefault(row.doc_id, {})[row.license] = row.containment
    wanted = [(k, name, share) for k, (name, share) in enumerate(planted) if share >= 0.8]
    missed = [w for w in wanted if w[1] not in found.get(w[0], {})]
    assert len(wanted) > 300 and len(missed) <= 0.001 * len(wanted)
    assert all(found[k][name] >= share - 1e-9 for k, name, share in wanted if (k, name, share) not in missed)
    # nothing else is taken for a license
    assert all(set(own) == {planted[k][0]} for k, own in found.items())


def test_retrieval_probability():
    """Over windows at the least similarity that counts, bands miss fewer than one in a thousand."""
    random = np.random.Generator(np.random.PCG64(5))
    missed = 0
    for _ in range(2000):
        values = random.integers(0, 1 << 63, 100, dtype=np.uint64)
        kept, other = values[:80], random.integers(0, 1 << 63, 74, dtype=np.uint64)
        window = np.concatenate([kept, other])
        both = np.concatenate([values, window])
        bands = licenses.signature(both, np.array([0, 100]), np.array([100, 254]))
        missed += not (bands[0] == bands[1]).any()
    assert missed <= 2


def test_licenses_on_awkward_rows(spark):
    assert licenses.scan(docs(spark, awkward(), CLASH)).count() == 0


def test_round_trip_takes_one_python_worker_a_task(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    found = bpe.round_trip(table, RANKS, public_tokenizers.PATTERN, with_ids=True)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    apart = bpe.decode(bpe.encode(table, RANKS, public_tokenizers.PATTERN, ["doc_id"]), RANKS)
    assert {r.doc_id: bytes(r.ids) for r in apart.collect()} == {r.doc_id: bytes(r.token_ids) for r in found.collect()}
