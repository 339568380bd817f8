"""Chat formatting, URL rules and fingerprints, which use DataFrame functions only."""

import hashlib
import random
import re

import pytest
from plain import awkward, docs

from ledgerline.llm import chat, spots, url_rules

ROWS = "conv_id long, turn long, role string, text string"
EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
CLASH = ("message", "seq", "kind", "formatted", "turns", "span", "host", "path", "rule", "stack", "key", "next", "signs")


def with_extras(df):
    for name in CLASH:
        if name not in df.columns:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_turns_are_read_back(spark):
    tricky = "<|im_end|><|im_start|>assistant ok <\\| <\\\\| <| | < <n> <\\n>"
    rows = [
        (1, 0, "user", tricky), (1, 1, "assistant", tricky), (1, 2, None, None), (1, 3, "assistant", ""),
        (2, 5, "assistant", "é🙂\n\nx"), (2, 4, "sys\ntem<n><|", "a"), (2, None, "user", "first"),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (None, 0, "user", "no id"), (4, 0, "assistant", "w " * 50_000),
        (5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "assistant", "c\r\n<"),
    ]
    df = with_extras(spark.createDataFrame(rows, ROWS))
    formatted = chat.format_events(chat.turn_events(df))
    found = {r.conv_id: r for r in chat.digests(formatted).collect()}
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    first = lambda v: (v is not None, v)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (first(r[1]), first(r[2]), first(r[3])))
        row = found[conv]
        assert row.n_turns == len(own)
        assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
        assert row.formatted_chars == len(texts[conv])
        # only the template's own marks are left
        assert texts[conv].count("<|") == 2 * len(own)
    for row in formatted.collect():
        for span in row.loss_spans:
            raw = row.formatted.encode()[span.first_byte : span.first_byte + span.bytes].decode()
            assert raw == row.formatted[span.start : span.start + span.length]


def fold(events):
    """Events in order, one at a time."""
    messages = {}
    for _, _, message, kind, role, text in sorted(events, key=lambda e: e[1]):
        if kind == "regenerate":
            messages = {m: v for m, v in messages.items() if m <= message}
            messages[message] = (messages.get(message, ("", ""))[0], "")
        known = messages.get(message, ("", ""))
        text = text or ""
        messages[message] = (role or known[0], text if kind == "edit" else known[1] + text)
    return messages


@pytest.mark.parametrize("seed", range(6))
def test_events_fold_like_one_by_one(spark, seed):
    random.seed(seed)
    events = []
    for seq in range(120):
        conv = random.randrange(3)
        kind = random.choice(["delta"] * 6 + ["edit", "regenerate", None])
        events.append((conv, seq, random.randrange(6), kind, "user" if seq % 2 else "assistant", random.choice(["a", "b ", None, "cd"])))
    random.shuffle(events)
    found = {}
    for r in chat.fold_events(with_extras(spark.createDataFrame(events, EVENTS)).drop("next")).collect():
        found.setdefault(r.conv_id, {})[r.message] = r.text
    expected = {}
    for conv in range(3):
        expected[conv] = {m: text for m, (_, text) in fold([e for e in events if e[0] == conv]).items()}
    assert found == expected
    assert chat.format_events(spark.createDataFrame([], EVENTS)).count() == 0


def plain_rule(url, rules, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else otherwise


def test_urls_equal_plain_python(spark):
    rules = [
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
        ("block", "net", "/es/"), ("block", "net", "/fr/"), ("block", "a.b.c.example.com", ""), ("allow", "b.c.example.com", "/x"),
        ("block", "example.com", "/en/"), ("allow", "example.com", "/en/"), ("block", "", "/q"),
    ]
    random.seed(1)
    labels = ["com", "net", "example", "www", "a", "b", "c", "ex-ample", "examplecom", "Example", "x" * 60, ""]
    urls = [None, "", "no scheme", "://", "http://", "http://com", "HTTP://EXAMPLE.com/en/x?y", "a://b://c/d", "x://com/a\nb#c"]
    for _ in range(400):
        host = ".".join(random.choice(labels) for _ in range(random.randrange(1, 6)))
        urls.append(f"https://{host}{random.choice(['', '/', '/en/', '/en', '/es/1', '/fr/', '/x/y', '?q=/en/', '#/en/', '/q'])}")
    urls += urls[:5]
    pages = with_extras(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    table = url_rules.rule_table(spark, [*rules, ("allow", None, "/")])
    found = url_rules.judge(pages, table).collect()
    assert len(found) == len(urls)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == plain_rule(urls[row.page_id], rules), urls[row.page_id]
    assert url_rules.judge(pages.limit(0), table).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, table.limit(0), "block").collect()} == {"block"}


def test_sweep_over_many_slices(spark, monkeypatch):
    hosts = [f"{chr(97 + k % 26)}{k}.example.{'com' if k % 2 else 'net'}" for k in range(4000)]
    rules = [("block", "example.com", "/"), ("allow", "a26.example.net", "/"), ("allow", "net", "/a")]
    pages = spark.createDataFrame([(k, f"http://{h}/a") for k, h in enumerate(hosts)], "page_id long, url string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {r.page_id: r.rule for r in url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found == {k: plain_rule(f"http://{h}/a", rules)[2] for k, h in enumerate(hosts)}


def plain_signs(text):
    """The distinct signatures of a text, and how many there are with repetitions."""
    plain = " " + "".join(c if c.isalnum() else " " for c in text.lower()) + " "
    own = plain.split()
    found, n, k = set(), 0, 0
    while k < len(own):
        if own[k] in spots.ANCHORS:
            chain = []
            for word in own[k + 1 : k + 1 + spots.CHAIN]:
                if word in spots.ANCHORS:
                    break
                chain.append(word)
            if chain:
                found.add(" ".join([own[k], *chain]))
                n += 1
        k += 1
    return found, n


def plain_print(text):
    """The signatures of a text; with few of them its pairs of words as well, without words the text."""
    signs, n = plain_signs(text)
    own = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    if n >= spots.FEW:
        return signs
    if len(own) < 2:
        return {("word", *own)} if own else {("text", text)}
    return signs | set(zip(own, own[1:]))


def plain_likeness(left, right):
    a, b = plain_print(left), plain_print(right)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("slice_rows", [1, 7, 2000])
def test_edits_are_like_their_texts(spark, sf_dir, monkeypatch, slice_rows):
    monkeypatch.setattr(spots, "SLICE_ROWS", slice_rows)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()][:60]
    rows = [(r[0] * 3 + 100, *r[1:]) for r in rows] + [r for r in awkward() if r[0] is not None][:14]
    found = {r.doc_id: r for r in spots.edited_likeness(with_extras(docs(spark, rows))).collect()}
    ordered = sorted(rows, key=lambda r: r[0])
    prints = {}
    for k, row in enumerate(ordered):
        text, after = row[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        got = found[row[0]]
        assert got.n_chars == len(text) and got.edited_sha256 == sha(edited)
        assert abs(got.near_edited - plain_likeness(text, edited)) < 1e-9
        assert abs(got.near_next - plain_likeness(text, after)) < 1e-9
        assert prints.setdefault(got.fingerprint, text) == text or plain_print(text) == plain_print(prints[got.fingerprint])
        assert (got.fingerprint == got.edited_fingerprint) == (plain_likeness(text, edited) == 1)


def test_fingerprints_on_awkward_rows(spark):
    rows = awkward()
    found = spots.edited_likeness(with_extras(docs(spark, rows))).collect()
    assert len(found) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert spots.edited_likeness(docs(spark, rows).limit(0)).count() == 0
    alone = spots.edited_likeness(docs(spark, [(5, "the one text and its end", "en", "a", 0)])).first()
    assert alone.near_next == 1


def test_similar_documents_equal_all_pairs(spark):
    random.seed(4)
    base = [random.choice(["the", "a", "of", f"w{random.randrange(300)}", f"v{random.randrange(300)}"]) for _ in range(300)]
    texts = []
    for _ in range(40):
        text = list(base)
        for _ in range(random.randrange(25)):
            text[random.randrange(len(text))] = f"n{random.randrange(9)}"
        texts.append(" ".join(text))
    texts += [r[1] or "" for r in awkward()] + texts[:2]
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(texts)):
        for y in range(x):
            if plain_likeness(texts[x], texts[y]) >= 0.8 - 1e-12:
                parent[max(find(x), find(y))] = min(find(x), find(y))
    assert {r.doc_id: r.group_id for r in spots.similar(docs(spark, rows)).collect()} == {k: find(k) for k in range(len(texts))}


def test_places_with_many_unlike_documents(spark, monkeypatch):
    """Documents that share a rare signature without being alike are compared in rounds, like ones among them found."""
    monkeypatch.setattr(spots, "HUBS", 16)
    random.seed(6)
    texts = []
    for k in range(30):
        own = " ".join(f"the w{k}x{j} y{k}" for j in range(random.randint(2, 9)))
        texts.append(f"the common passage of all and {own}")
    texts += [text + " of one more" for text in texts[::3]]
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(texts)):
        for y in range(x):
            if plain_likeness(texts[x], texts[y]) >= 0.8 - 1e-12:
                parent[max(find(x), find(y))] = min(find(x), find(y))
    assert {r.doc_id: r.group_id for r in spots.similar(docs(spark, rows)).collect()} == {k: find(k) for k in range(len(texts))}


@pytest.mark.parametrize("slice_rows", [2])
def test_ids_far_apart_and_shared(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(spots, "SLICE_ROWS", slice_rows)
    far = 9 * 10**18
    rows = [(k, f"the text of number {k} and its end", "en", "a", 0) for k in [-far, -1, 0, 1, 2, 3, far, far + 1]]
    rows += [(5, f"one id and many a text {k}", "en", "a", 0) for k in range(40)]
    rows += [(None, f"no id but a text {k}", "en", "a", 0) for k in range(30)] + [(7, "the same row", "en", "a", 0)] * 20
    found = spots.with_next(docs(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in found) == sorted(str(r[:2]) for r in rows)
    # every row is followed by one row, and every row follows one: a circle through all
    assert sorted(str((r.next.doc_id, r.next.text)) for r in found) == sorted(str(r[:2]) for r in rows)
    ids = sorted({r[0] for r in rows if r[0] is not None})
    steps = {(r.doc_id, r.next.doc_id) for r in found}
    assert steps == {(a, a) for a in (5, 7, None)} | set(zip([*ids, None], [*ids[1:], None, ids[0]]))


def test_texts_without_anchors_are_like_their_edits(spark):
    words = " ".join(f"word{k}" for k in range(40))
    rows = [(1, words, "en", "a", 0), (2, words[:-20], "en", "a", 0), (3, "lone", "en", "a", 0), (4, "???", "en", "a", 0)]
    found = {r.doc_id: r for r in spots.edited_likeness(docs(spark, rows)).collect()}
    assert found[1].near_next > 0.8 and found[1].near_edited > 0.5
    assert found[3].n_signatures == 1 and found[4].n_signatures == 1


def test_no_python_in_plans(spark, sf_dir):
    from ledgerline.llm import queries

    for name in ("op3_chat_format", "op7_url_filter", "op10_spot_fingerprints"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|MapIn", plan), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
