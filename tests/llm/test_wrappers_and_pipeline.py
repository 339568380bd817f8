"""HTML extraction on pages of known content, and the pipeline against its own parts."""

import importlib.util

import corpus_pipeline
import pytest
from plain import awkward, docs, groups

import __spark_entry__ as entry
from ledgerline.llm import wrappers

PAGES = "page_id long, url string, html string"


def layout(kind, title, blocks, k):
    """A page of one of several sites."""
    if kind == 0:
        body = "".join(f"<p>{b}</p>" for b in blocks)
        return (
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var a='</p>';</script></head>"
            f"<body><nav><ul><li><a href='/{k}'>m{k}</a></li><li>n</li></ul></nav><!-- ad {k} --><div class='ad'>buy {k}</div>"
            f"<article><h1>{title}</h1>{body}</article><footer>&copy; x {k}</footer>"
        )
    if kind == 1:
        body = "".join(f"<h2>{b}</h2><p>{b} text" for b in blocks)
        return (
            f"<html><body><header><h1>Site name</h1><p>slogan</p></header><div class='cookie-notice'>We use cookies</div>"
            f"<main><form><label>Search</label><input></form><h1>{title}</h1>{body}"
            f"<aside><p>related {k}</p></aside></main><section id=comments><p>nice {k}!</p><p>first</p></section></body></html>"
        )
    body = "".join(f"<p class=t{j}>{b}</p>" for j, b in enumerate(blocks))
    return (
        f"<body><div class='header'>Home</div><div class='sidebar widget'><ul><li>one</li></ul></div>"
        f"<div class='post-12'><p>Welcome to this site, dear reader</p><h1>{title}</h1>{body}</div><div class=footer>end {k}</div>"
    )


def expected(kind, title, blocks):
    if kind == 1:
        return [title, *[x for b in blocks for x in (b, f"{b} text")]]
    return [title, *blocks]


def test_known_pages(spark):
    rows, want = [], {}
    for k in range(60):
        kind = k % 3
        blocks = [f"block {j} of page {k} with words" for j in range(1 + k % 5)]
        title = f"Title {k}"
        rows.append((k, f"http://site{kind}.example.com/{k}", layout(kind, title, blocks, k)))
        want[k] = "\n\n".join(expected(kind, title, blocks))
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS text", "'y' AS host", "1 AS blocks", "2 AS shape")
    found = {r.page_id: r for r in wrappers.extract(df).collect()}
    for k in want:
        assert found[k].text == want[k], (k, found[k].text)
        assert found[k].n_chars == len(want[k])


def test_a_host_with_two_layouts(spark):
    rows = [(k, "http://a.com/x", layout(k % 3, f"T{k}", [f"own {k}", f"more {k}"], k)) for k in range(30)]
    found = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(30):
        assert found[k] == "\n\n".join(expected(k % 3, f"T{k}", [f"own {k}", f"more {k}"])), k


def test_a_line_that_all_pages_share_stays(spark):
    rows = [
        (k, "http://a.com/x", layout(0, f"T{k}", ["the same line in all pages", f"own {k}", "the same line in all pages"], k))
        for k in range(20)
    ]
    for row in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect():
        assert row.text.count("the same line in all pages") == 2 and f"own {row.page_id}" in row.text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article></article>", ""),
        ("plain text &amp; no tags", "plain text & no tags"),
        ("<article><p>a &lt;b&gt; &#233;&eacute;&nbsp;c\n\t d<br>e</article>", "a <b> éé c d e"),
        ("<article><p>1 < 2 and <b>bold<i>x</b></i></p></div></p><p>next", "1 < 2 and boldx\n\nnext"),
        ("<article>loose<p>in</p>tail<ul><li>one<li>two</ul></article>", "loose\n\nin\n\ntail\n\none\n\ntwo"),
        ("<article><p>a</p><script>x<p>no</p></script><style>s</style><!-- c <p>no</p> --><p>b</p></article>", "a\n\nb"),
        ("<article><p>a<table><tr><td>1<td>2<tr><td>3</table></article>", "a\n\n1\n\n2\n\n3"),
        ('<article><p title="a > b">x</p><p>unclosed attribute <a href="y>z</p></article>', "x\n\nunclosed attribute z"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
        ("<article><p>" + "long " * 100_000 + "</p></article>", ("long " * 100_000).strip()),
    ],
)
def test_odd_sources(spark, source, text):
    df = spark.createDataFrame([(1, None, source), (1, None, source), (None, "x", None)], PAGES)
    found = wrappers.extract(df).collect()
    assert len(found) == 3
    assert [r.text for r in found if r.page_id == 1] == [text, text]


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<p>a</p><video-player id=1></video-player><p>b</p>", ["a", "b"]),
        ("<p>a</p><svg width=1/><p>b</p><svg><path d=''/><g>no</g></svg><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><video src='x > y'><p>b</p><canvas>no</canvas><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><svg><p>b</p><svg>no</svg><p>c</p><audio>no</audio >d", ["a", "b", "c", "d"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><math/><p>b</p>", ["so x=1 holds", "b"]),
        ("<p>a</p><noscript><p>b</p></noscript><object data=x><p>c</p></object><p>d</p>", ["a", "b", "c", "d"]),
        ("<p>a</p><xmp><b>&amp;</b></xmp><p>b</p>", ["a", "<b>&amp;</b>", "b"]),
        ("<p>a</p><script src=x>var p='<p>no</p>'</script x><script-like>b</script-like><style>no", ["a", "b"]),
        ("<p>a</p><!--><p>b</p><!-- no --!><p>c</p><textarea>no</textarea>", ["a", "b", "c"]),
    ],
)
def test_only_scripts_and_media_are_skipped(source, blocks):
    assert [text for _, text in wrappers.parse(f"<article>{source}</article>")[1]] == blocks


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<main><h1>T</h1><p>long main text</p></main><article><p>card</p></article>", "T\n\nlong main text"),
        ("<main><p>long main text</p><article><p>card</p></article></main>", "long main text\n\ncard"),
        ("<article><p>card</p></article><div class=content><p>long main text</p></div>", "long main text"),
        ("<div class=content><p>intro</p><article><p>body</p></article><p>outro</p></div>", "intro\n\nbody\n\noutro"),
        ("<p>outside</p><article><p>one</p></article><h2>x</h2><article class=b><p>two</p></article>", "one\n\ntwo"),
    ],
)
def test_the_main_container_stays_whole(spark, source, text):
    df = spark.createDataFrame([(1, "http://a.com/x", f"<body>{source}</body>")], PAGES)
    assert [r.text for r in wrappers.extract(df).collect()] == [text]


PROSE = "This sentence is long enough to be read as one, and it ends like one."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # names around the main container, or that only mention a part, say nothing
        ("<div class='layout has-sidebar'><main><h1>T</h1><p>body</p></main></div>", "T\n\nbody"),
        ("<div class='post no-sidebar'><h1>T</h1><p>body</p></div>", "T\n\nbody"),
        ("<div class='sidebar-left'><div class=sidebar>links</div><main><p>body text</p></main></div>", "body text"),
        (f"<div class='page with-header'><div class=header>Site</div><div class=content><p>{PROSE}</p></div></div>", PROSE),
        (f"<div class='overlay wrapper'><h1>T</h1><p>{PROSE}</p></div><div class=menu>m</div>", f"T\n\n{PROSE}"),
        # inside an article names vote, and prose stands against them
        (f"<article><section class=discussion><h2>Discussion</h2><p>{PROSE}</p></section></article>", f"Discussion\n\n{PROSE}"),
        (f"<article><p>a</p><section id=search-algorithms><p>{PROSE}</p></section></article>", f"a\n\n{PROSE}"),
        ("<article><p>body</p><div class=share-price><p>12.40 today</p></div></article>", "body\n\n12.40 today"),
        ("<article><p>body</p><div class='side effects'><ul><li>nausea<li>headache</ul></div></article>", "body\n\nnausea\n\nheadache"),
        (f"<main><p>body</p><div class=notice><p>{PROSE}</p></div></main>", f"body\n\n{PROSE}"),
        ("<main><p>body</p><div class=share-buttons><a href=x>Tweet</a> <a href=y>Mail</a></div></main>", "body"),
        (f"<main><p>body</p><div class=related-posts><a href=x>{PROSE}</a></div></main>", "body"),
        ("<main><p>body</p><div class=ad>buy now</div></main>", "body"),
        # tags and roles decide, and so do reader comments
        (f"<article><p>body</p><aside><p>{PROSE}</p></aside><nav>x</nav></article>", "body"),
        (f"<article><p>body</p><div id=comments><p>{PROSE}</p><p>{PROSE}</p></div></article>", "body"),
        (f"<div class=content><p>{PROSE}</p></div><div class=comment-list>" + f"<p>{PROSE}</p>" * 9 + "</div>", PROSE),
        (f"<main><p>{PROSE}</p></main><aside><article><p>card</p></article></aside>", PROSE),
        # a form around everything is a container; one beside the article is a form
        (f"<form id=f><div class=content><h1>T</h1><p>{PROSE}</p><button>Go</button></div></form>", f"T\n\n{PROSE}"),
        (f"<form><main><p>{PROSE}</p></main><select><option>x</select></form>", PROSE),
        (f"<article><p>{PROSE}</p><form><p>Your mail address, please.</p></form></article>", PROSE),
        # a menu stays one however long it is
        ("<div class=menu>" + "<a href=x>one more link of the menu</a> " * 20 + "</div><p>body</p>", "body"),
        ("<article><p>one</p><svg><g>no</g><text x=1>two <tspan>three</tspan></text></svg><p>four</p></article>", "one\n\ntwo three\n\nfour"),
    ],
)
def test_names_are_hints(spark, source, text):
    df = spark.createDataFrame([(1, "http://a.com/x", f"<html><body>{source}</body></html>")], PAGES)
    assert [r.text for r in wrappers.extract(df).collect()] == [text]


def test_votes_count_over_the_pages_of_a_host(spark):
    """A box that says the same on most pages is furniture, whatever it says; one that varies is text."""
    page = "<article><h1>T{0}</h1><p>{1} {0}</p><div class=notice><p>{2}</p></div></article>"
    rows = [(k, "http://a.com/x", page.format(k, PROSE, PROSE)) for k in range(9)]
    rows += [(20 + k, "http://b.com/x", page.format(k, PROSE, f"{k} things. {PROSE}")) for k in range(9)]
    found = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[k] == f"T{k}\n\n{PROSE} {k}" for k in range(9))
    assert all(found[20 + k] == f"T{k}\n\n{PROSE} {k}\n\n{k} things. {PROSE}" for k in range(9))


def random_site(random, site):
    """A function that renders an article of one site, whose template is drawn once."""
    wrap = random.choice([
        "<article class='{0}'>{1}</article>", "<main id={0}>{1}</main>", "<div class='post {0}'>{1}</div>",
        "<div class='has-{0}'><div class=content>{1}</div></div>", "<div role=main>{1}</div>", "<form id=form0><main>{1}</main></form>",
    ])
    kind = random.choice(["single", "narrow", "theme-0", "sidebar-none"])
    before = random.sample(
        ["<nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>", "<header><h2>Site</h2><p>The slogan of this site.</p></header>",
         "<div class=cookie-notice>We use cookies.</div>", "<div class='banner ad-box'>Buy {k} now</div>"], random.randint(1, 4),
    )
    after = random.sample(
        ["<aside><h3>Related</h3><a href=/{k}>Other {k}</a></aside>", "<footer>&copy; {k} by us</footer>",
         "<section id=comments><p>Reader {k} says that this was well done.</p></section>",
         "<form action=/search><label>Search</label><input name=q></form>", "<script>var x = '<p>{k}</p>';</script>"], random.randint(1, 5),
    )
    inner = random.choice(["<div class=share-buttons><a href=#>Tweet</a><a href=#>Mail</a></div>", "<aside><p>See also {k}</p></aside>", ""])

    def render(k, blocks):
        parts = []
        for j, (tag, text) in enumerate(blocks):
            parts.append(f"<ul><li>{text}</li></ul>" if tag == "li" else f"<{tag}>{text}</{tag}>")
            if j == 1:
                parts.append(inner)
        body = "".join(parts)
        page = "".join(before) + wrap.format(kind, body) + "".join(after)
        return f"<html><head><title>t</title></head><body class='page-{site}'>{page.replace('{k}', str(k))}</body></html>"

    return render


def test_random_sites_give_their_articles(spark):
    """Known articles in drawn templates come back whole, and nothing else with them."""
    import random as standard

    random = standard.Random(11)
    rows, want = [], {}
    for site in range(24):
        render = random_site(random, site)
        for k in range(random.choice([1, 2, 12])):
            blocks = [("h1", f"Title {site} {k}")]
            for j in range(random.randint(1, 9)):
                words = " ".join(random.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=random.randint(6, 40)))
                blocks.append((random.choice(["p", "p", "p", "h2", "li", "blockquote", "pre"]), f"{words} {site} {k} {j}."))
            number = site * 100 + k
            rows.append((number, f"https://site{site}.org/{k}", render(k, blocks)))
            want[number] = "\n\n".join(text for _, text in blocks)
    found = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert {k: found[k] for k in want if found[k] != want[k]} == {}


def test_many_irregular_siblings():
    """Two pages of twenty thousand siblings in no order are aligned in bounded memory."""
    import random as standard
    import time
    import tracemalloc

    random = standard.Random(2)
    pages = []
    for _ in range(2):
        items = "".join(f"<div class={random.choice('abcdefghijklmnop')}{random.choice('xyz')}>t</div>" for _ in range(20_000))
        pages.append(wrappers.parse(f"<body>{items}</body>")[0])
    started = time.perf_counter()
    tracemalloc.start()
    both = wrappers.align(*pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20 and time.perf_counter() - started < 60
    labels = {label for page in pages for _, path, _ in page.slots() for label in path}
    assert {label for _, path, _ in both.slots() for label in path} == labels
    placed = wrappers.slot_map(pages[0], both)
    assert len(placed) == len(list(pages[0].slots())) and time.perf_counter() - started < 60


@pytest.mark.parametrize("seed", range(20))
def test_walk_is_a_longest_common_subsequence(seed):
    import random as standard

    random = standard.Random(seed)
    a, b = ([random.choice("abcd") for _ in range(random.randint(0, 40))] for _ in range(2))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for x in range(len(a) - 1, -1, -1):
        for y in range(len(b) - 1, -1, -1):
            best[x][y] = best[x + 1][y + 1] + 1 if a[x] == b[y] else max(best[x + 1][y], best[x][y + 1])
    ways = list(wrappers._common(a, b))
    assert ways.count(0) == best[0][0]
    assert ways.count(0) + ways.count(1) == len(a) and ways.count(0) + ways.count(2) == len(b)
    x = y = 0
    for way in ways:
        assert way or a[x] == b[y]
        x, y = x + (way != 2), y + (way != 1)


def test_slots_outside_the_wrapper_keep_their_own_rank():
    wrapper = wrappers.parse("<body><p>a</p></body>")[0]
    page = wrappers.parse("<body><article><p>a</p></article><p>b</p><nav>c</nav></body>")[0]
    assert wrappers.slot_map(page, wrapper) == [wrappers.ALONE - 3, wrappers.ALONE, wrappers.NOWHERE]


def test_empty_pages(spark):
    assert wrappers.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_alignment():
    def shape(source):
        return wrappers.parse(source)[0]

    one = shape("<body><h1>a</h1><p>b</p></body>")
    two = shape("<body><p>b</p><p>c</p><ul><li>x</li></ul></body>")
    both = wrappers.align(one, two)
    body = both.items[0]
    assert [(i.label, i.many, i.maybe) for i in body.items] == [("h1", False, True), ("p", True, False), ("ul", False, True)]
    pairs = shape("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>")
    assert [i.label for i in pairs.items[0].items] == [""] and pairs.items[0].items[0].many
    single = shape("<dl><dt>a</dt><dd>b</dd></dl>")
    merged = wrappers.align(pairs, single)
    assert [i.label for i in merged.items[0].items] == [""] and not merged.items[0].items[0].maybe
    assert len(wrappers.slot_map(single, merged)) == 2


def test_expressions_are_aligned_in_bounded_blocks(spark, tmp_path, monkeypatch):
    """A host of many expressions, with the number of them that each call aligns written down."""
    folder = str(tmp_path)
    align_all = wrappers._align_all

    def counted(shapes):
        import uuid

        with open(f"{folder}/{uuid.uuid4()}", "w") as file:
            file.write(str(len(shapes)))
        return align_all(shapes)

    def plan(k, n):
        # as many expressions as subsets of ten tags
        tags = "ul ol dl table pre blockquote h2 h3 h4 h5".split()
        return "".join(f"<{tag}>x{n}</{tag}>" for j, tag in enumerate(tags) if k >> j & 1)

    monkeypatch.setattr(wrappers, "_align_all", counted)
    shapes = {("big.com", wrappers.parse(f"<article><p>a</p>{plan(k, k)}</article>")[0]) for k in range(1000)}
    rows = [(host, wrappers.json.dumps(shape.dump())) for host, shape in shapes] + [("small.com", '["",0,[["#",0,[]]]]')]
    df = spark.createDataFrame(rows, "host string, shape string").distinct()
    found = {r.host: r.shape for r in wrappers.infer_wrappers(df).collect()}
    assert sorted(found) == ["big.com", "small.com"]
    sizes = [int(path.read_text()) for path in tmp_path.iterdir()]
    assert sum(sizes) >= len(rows) and max(sizes) <= 64
    wrapper = wrappers.Node.load(wrappers.json.loads(found["big.com"]))
    labels = {label for _, path, _ in wrapper.slots() for label in path}
    assert labels >= set("p ul ol dl table pre blockquote h2 h3 h4 h5".split())


def test_copies_do_not_make_an_article_the_template(spark):
    copy = "<body><div class=post><h1>T</h1><p>the only paragraph</p></div><link href=/{}></body>"
    rows = [(k, f"http://a.com/{k}", copy.format(k)) for k in range(4)]
    rows += [(9, "http://a.com/9", "<body><div class=post><h1>U</h1><p>another paragraph</p></div></body>")]
    # articles that differ in nothing but what is around them
    other = "<body><p>seen {} times</p><article><h1>T</h1><blockquote>body</blockquote></article></body>"
    rows += [(20 + k, f"http://b.com/{k}", other.format(k)) for k in range(4)]
    found = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[k] == "T\n\nthe only paragraph" for k in range(4)) and found[9] == "U\n\nanother paragraph"
    assert all(found[20 + k] == "T\n\nbody" for k in range(4))


def test_asides_count_at_any_depth(spark):
    deep = "<p>keep</p><nav><p>menu</p></nav><div class=comments><div>c</div></div><footer>f</footer><p>also</p>"
    top = "<header><p>site</p><h1>title</h1></header>"
    rows = [
        (1, "http://a.com/x", "<article>" + "<div>" * 70 + deep),
        (2, "http://b.com/x", "<p>outside</p>" + "<div>" * 70 + f"<main>{top}{deep}</main>"),
        (3, "http://c.com/x", "<article>" + "<div class=comments><div class=content>" * 2000 + "c</article>"),
        (4, "http://d.com/x", "<article>" + "<div>" * 70 + "<h1><div class=content><header>" * 1000 + "c"),
    ]
    found = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[1] == "keep\n\nalso" and found[2] == "title\n\nkeep\n\nalso" and found[3] == ""


def test_every_operator_is_registered():
    names = set(entry.queries())
    for number in range(1, 11):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_dedup", "mix_sources", "byte_bpe",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages_on_a_fixture(spark, tmp_path):
    """Every stage's result against plain Python on what the stage before it has written."""
    from ledgerline.llm import line_rules, mixing, quality_model
    from test_bpe_mixing_licenses import encoding

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs(spark, [(1_000_000 + (r[0] or 0), *r[1:]) for r in awkward()])
    folder = str(tmp_path)
    source.unionByName(extra).selectExpr("*", "'x' AS kept").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    columns = table.columns
    made = [table]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, made[-1], folder)
        out.write.parquet(f"{folder}/{name}.parquet")
        made.append(spark.read.parquet(f"{folder}/{name}.parquet"))
        if name != "byte_bpe":
            assert made[-1].columns == columns
    rows = [[r.asDict() for r in df.collect()] for df in made]
    ids = [sorted(r["doc_id"] for r in part) for part in rows]
    assert ids[1] == sorted(r.doc_id for r in line_rules.judge(table).filter("kept").collect())
    model = quality_model.train(table, spark.read.parquet(f"{folder}/labels.parquet"))
    assert ids[2] == sorted(r.doc_id for r in quality_model.score(made[1], model).filter("predicted = 1").collect())
    texts = [r["text"] for r in rows[2]]
    members, _ = groups(texts, 5, 80)
    least = {}
    for row, group in zip(rows[2], members, strict=True):
        least[group] = min(least.get(group, row["doc_id"]), row["doc_id"])
    assert ids[3] == sorted(least.values())
    copies = {r.doc_id: r.copies for r in mixing.mix(made[3]).collect()}
    assert ids[4] == sorted(k for k, n in copies.items() for _ in range(n))
    library = encoding()
    by_id = {r["doc_id"]: r["text"] for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    assert all(r["n_tokens"] == len(library.encode_ordinary(by_id[r["doc_id"]])) for r in rows[5])
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.ids_sha256) for r in whole.collect()) == sorted((r["doc_id"], r["ids_sha256"]) for r in rows[5])


def test_rest_does_not_need_this_part():
    assert importlib.util.find_spec("ledgerline.catalog") is not None
    source = importlib.util.find_spec("ledgerline.catalog").origin
    with open(source) as file:
        assert "llm" not in file.read()
