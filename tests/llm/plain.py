"""Plain Python versions of what the operators compute, and tables with awkward rows."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{k % 977} x{k % 31}" for k in range(30_000))


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def awkward():
    """Rows with NULLs, empty and long texts, copies and repeated rows."""
    texts = [
        None, "", " \n\t ", "one", "One", "two words", LONG, LONG, "é" * 5000, "a\x00b \x0b c",
        "the cat sat on the mat and the dog sat on the rug while it was raining outside all day",
        "the cat sat on the mat and the dog sat on the rug while it was raining outside all day",
        "line of ten words that is said again and again here\n" * 3, "Ünïcödé 日本語 テスト 🙂🙂 end",
    ]
    rows = [(k, text, None if k % 3 else "en", None if k % 4 == 1 else f"src{k % 2}", None) for k, text in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, "no id here at all", "en", "src0", 1), (None, None, None, None, None)]


def docs(spark, rows, clash=()):
    """A documents table, with extra columns of the given names."""
    df = spark.createDataFrame(rows, DOCS)
    for name in clash:
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def shingles(text, size):
    found = words(lower(text))
    if not found:
        return frozenset()
    if len(found) < size:
        return frozenset([tuple(found)])
    return frozenset(zip(*[found[k:] for k in range(size)], strict=False))


def groups(rows, size, percent):
    """The component of every row position, by comparing all pairs of sets."""
    sets = [shingles(text, size) for text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    return [find(x) for x in range(len(rows))], sets


def base_counts(text):
    found = words(text)
    windows = Counter(tuple(found[k : k + 5]) for k in range(len(found) - 4))
    covered = set()
    for k in range(len(found) - 4):
        if windows[tuple(found[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
