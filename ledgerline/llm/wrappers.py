"""HTML extraction by wrappers: union-free regular expressions inferred per host.

A page is a stream of block tags and text slots. Its expression has a slot for every text, with
adjacent repetitions folded into repeated groups. The expressions of a host are aligned one after
the other: what only one side has becomes optional, what one side repeats becomes repeated, and
the result is the host's wrapper. A page's texts then belong to the wrapper's slots, and a slot is
judged by its place in the wrapper and by how its texts vary over the pages of the host.

Tags and roles decide what a container is. A class or id is a hint only: it counts for nothing on
what holds the page's main container or most of its text, and inside an article it is a vote, which
stands if the container's texts over all pages of the host read like furniture: links, scraps, or
one text on most pages.

A page is parsed once. Alignment works on the distinct expressions of a host only, in blocks of
bounded size and then on the blocks' wrappers, round after round, so a host that has a third of
all pages is no different from others. Two lists of siblings are aligned on bits of whole numbers,
with the square root of their length kept in rows, so pages of very many siblings fit as well.
"""

from __future__ import annotations

import html
import itertools
import json
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import CHECK, KEY, in_small_batches
from ledgerline.llm.url_rules import host_of
from ledgerline.session import materialize

# expressions of a host that one task aligns at once
BLOCK = 64
# expressions of a host that are put into its wrapper at once
PLACED = 512
# containers nested deeper than this add no level of their own, unless their texts are judged by it
DEPTH = 60
# a text that more than half of a slot's pages share, three at least, belongs to the template
TEMPLATE_PAGES = 3
TEMPLATE_PERCENT = 50
# numbers for slots that are not in the wrapper: ALONE less the slot's own rank, or NOWHERE
ALONE, NOWHERE = -2, -1
MAIN_RANKS = (3, 2, 1)

# tags that begin and end a block; all others are markup inside one
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html iframe legend li main menu nav ol option "
    "p pre search section select summary table tbody td template tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an open element of the first kind ends where one of the second begins
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
    "head": frozenset(["body"]),
} | {h: HEADINGS for h in HEADINGS}
# containers that hold something else than the article
ASIDE = frozenset(
    "head nav footer aside form menu dialog button select option template iframe legend search title fieldset".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
# words of classes and ids that name such a container
ASIDE_WORD = re.compile(
    r"ads?|advert\w*|ad(?:box|sense|slot|unit|wrap|block)|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification\w*|toast|"
    r"alert|popup|modal|overlay|newsletter|subscri\w+|signup|login|sidebar|side|aside|widgets?|related|recommend\w*|"
    r"share|sharing|social|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|header|masthead|toolbar|"
    r"comments?|commentlist|reply|replies|respond|discussion|disqus|search|skip|disclaimer"
)
COMMENT_WORD = re.compile(r"comments?|commentlist|replies|respond|disqus")
# of these, words that no layout around an article is named by
NEVER_WORD = re.compile(
    r"ads?|advert\w*|ad(?:box|sense|slot|unit|wrap|block)|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletter|subscri\w+|signup|"
    r"login|breadcrumbs?|pagination|pager|comments?|commentlist|reply|replies|respond|disqus|disclaimer"
)
# words that mean something else often enough, and say little beside a class that is no such name
DOUBTFUL = frozenset("side share search social discussion notice notices alert reply skip related header".split())
# words that go along with them, which leave a name what it is
PLAIN_WORDS = frozenset(
    "box bar wrap wrapper container inner outer list lists item items link links button buttons btn form area block section "
    "post posts article articles news site page main top bottom left right primary secondary global content row col column "
    "group panel module unit slot title text body icon icons media mobile desktop fixed sticky more story stories tag tags "
    "region holder inline small large default custom html first last even odd active open closed sm md lg xs xl".split()
)
# beginnings of names that speak of a part which is missing or elsewhere
MENTIONS = frozenset("no not non without has have with hide show is are js".split())
MAIN_ROLES = frozenset(["main", "article"])
MAIN_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article|articlebody|post|entry|story|content|main|maincontent|body|text)(?:$|[\s_-])"
)

# A script or style lasts to its end tag or the page's end. Sound, drawings and form fields are left out as a
# whole, of pictures the text elements stay, and an xmp is taken as it is written; of those, one that is closed at
# once or never ends with its own tag.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(script|style)(?=[\s/>])[^>]*(?:>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(textarea|svg|audio|video|canvas|noframes|xmp)(?=[\s/>])(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"(?:(?<=/>)|([^<]*+(?:<(?!/?\2[\s/>])[^<]*+)*+)</\2(?=[\s/>])[^>]*>)?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
PICTURE_TEXT = re.compile(r"<text(?=[\s/>])[^>]*+(?<!/)>(.*?)(?:</text(?=[\s/>])[^>]*>|\Z)", re.S | re.I)
MARKUP = re.compile(r"<[^>]*>")
SENTENCE_END = re.compile(r"[.!?\u2026:;\u3002\uff01\uff1f][\"'\u201d\u2019\u00bb)\]]*$")
# what names were found to say
_NAMES: dict[str, int] = {}
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
BREAKS = frozenset(["br", "hr", "wbr", "img", "input"])


class Node:
    """An element of an expression: a label, and items in order.

    ``many`` and ``maybe`` say that the element is repeated or optional. A text slot has the label
    "#"; a group of elements that repeat together has the label "".
    """

    __slots__ = ("label", "many", "maybe", "items", "slot")

    def __init__(self, label: str, many: bool = False, maybe: bool = False, items: list[Node] | None = None, slot: int = -1):
        self.label, self.many, self.maybe, self.slot = label, many, maybe, slot
        self.items = items if items is not None else []

    def key(self) -> str:
        return self.label if self.label else "".join(f"({i.key()})" for i in self.items)

    def dump(self) -> list:
        return [self.label, int(self.many) + 2 * int(self.maybe), [i.dump() for i in self.items]]

    @staticmethod
    def load(values: list) -> Node:
        label, flags, items = values
        return Node(label, bool(flags & 1), bool(flags & 2), [Node.load(i) for i in items])

    def placed(self) -> Iterator[tuple[Node, tuple[Node, ...], bool]]:
        """The text slots in order, with the labelled elements above them and whether they are repeated."""
        pending = [(self, (), False)]
        while pending:
            node, above, many = pending.pop()
            many = many or node.many
            if node.label == "#":
                yield node, above, many
            else:
                above = (*above, node) if node.label else above
                pending += [(i, above, many) for i in reversed(node.items)]

    def slots(self) -> Iterator[tuple[Node, tuple[str, ...], bool]]:
        """The text slots in order, with the labels above them and whether they are repeated."""
        for node, above, many in self.placed():
            yield node, tuple(n.label for n in above), many


def _label(tag: str, attributes: str) -> str:
    names, role = [], ""
    for found in ATTRIBUTE.finditer(attributes):
        value = (found[2] or found[3] or found[4] or "").lower()
        if found[1].lower() == "role":
            role = value
        else:
            names.append(re.sub(r"\d+", "0", value))
    return tag if not names and not role else "|".join([tag, " ".join(names), role])


def _merge_runs(items: list[Node]) -> list[Node]:
    """Folds equal neighbours into one repeated item, then neighbours that repeat in twos or threes."""
    folded: list[Node] = []
    for item in items:
        if folded and folded[-1].label == item.label != "":
            folded[-1] = align(folded[-1], item)
            folded[-1].many = True
        else:
            folded.append(item)
    for size in (2, 3):
        k = 0
        while k + 2 * size <= len(folded):
            unit = folded[k : k + size]
            end = k + size
            while [i.key() for i in folded[end : end + size]] == [i.key() for i in unit]:
                unit = [align(a, b) for a, b in zip(unit, folded[end : end + size], strict=True)]
                end += size
            if end > k + size:
                folded[k:end] = [Node("", many=True, items=unit)]
            k += 1
    return folded


def _fold_groups(items: list[Node], other: list[Node]) -> list[Node]:
    """Runs of ``items`` that are one round of a group of ``other`` become that group."""
    for group in (i for i in other if not i.label):
        keys, size = [i.key() for i in group.items], len(group.items)
        own = [i.key() for i in items]
        if not size or keys[0] not in own:
            continue
        folded, k = [], 0
        while k < len(items):
            if own[k : k + size] == keys:
                folded.append(Node("", items=items[k : k + size]))
                k += size
            else:
                folded.append(items[k])
                k += 1
        items = folded
    return items


def _common(a: list[str], b: list[str]) -> Iterator[int]:
    """How to walk two lists along a longest common subsequence: 0 for both, 1 for the first, 2 for the second.

    Row y of the table of lengths is a whole number with a bit per element of ``a``, which is not
    set where the element makes the subsequence of the rests longer. A row follows from the row
    after it in a few operations. Every so many rows one is kept, and those between are made again
    when the walk comes to them.
    """
    n, m = len(a), len(b)
    full = (1 << n) - 1
    # bit 0 is the last element, so that rows are made from the ends of the lists
    masks: dict[str, int] = {}
    for k, key in enumerate(reversed(a)):
        masks[key] = masks.get(key, 0) | 1 << k
    step = max(1, math.isqrt(m))

    def after(row: int, key: str) -> int:
        both = row & masks.get(key, 0)
        return ((row + both) | (row - both)) & full

    kept, row = [full], full
    for j in range(m):
        row = after(row, b[m - 1 - j])
        if (j + 1) % step == 0:
            kept.append(row)
    rows: list[int] = []
    first = -1
    x = y = 0
    while x < n and y < m:
        if a[x] == b[y]:
            yield 0
            x, y = x + 1, y + 1
            continue
        j = m - y
        if first < 0 or j < first:
            first = j // step * step
            rows = [kept[j // step]]
            while len(rows) <= j - first:
                rows.append(after(rows[-1], b[m - first - len(rows)]))
        if rows[j - first] >> (n - x - 1) & 1:
            yield 1
            x += 1
        else:
            yield 2
            y += 1
    yield from itertools.repeat(1, n - x)
    yield from itertools.repeat(2, m - y)


def align(left: Node, right: Node) -> Node:
    """The expression that matches what either of two expressions of one label matches.

    Matching parts are kept in order (a longest common subsequence), the rest becomes optional.
    """
    out = Node(left.label, left.many or right.many, left.maybe or right.maybe)
    a = _fold_groups(left.items, right.items)
    b = _fold_groups(right.items, left.items)
    ka, kb = [i.key() for i in a], [i.key() for i in b]
    if ka == kb:
        out.items = [align(x, y) for x, y in zip(a, b, strict=True)]
        return out
    x = y = 0
    for way in _common(ka, kb):
        if way == 0:
            out.items.append(align(a[x], b[y]))
            x, y = x + 1, y + 1
        elif way == 1:
            out.items.append(Node(a[x].label, a[x].many, True, a[x].items))
            x += 1
        else:
            out.items.append(Node(b[y].label, b[y].many, True, b[y].items))
            y += 1
    return out


def _is_prose(text: str, linked: int) -> bool:
    """Whether a text reads like a sentence, and is not mostly a link."""
    words = text.count(" ") + 1
    return 2 * linked < len(text) and (words >= 12 or (words >= 5 and bool(SENTENCE_END.search(text))))


def parse(source: str) -> tuple[Node, list[tuple[int, str]]]:
    """The expression of a page and its texts in order, each with the number of its slot there."""
    expression, texts = read_page(source)
    return expression, [(slot, text) for slot, text, _ in texts]


def read_page(source: str) -> tuple[Node, list[tuple[int, str, bool]]]:
    """The expression of a page and its texts in order: the number of the slot, the text, whether it is prose."""
    root = Node("")
    # below DEPTH an entry also has the labels above its texts
    stack: list[tuple[str, Node, tuple[str, ...]]] = [("", root, ())]
    texts: list[str] = []
    linked: list[int] = []
    leaves: list[Node] = []
    pending: list[str] = []
    in_link: list[str] = []
    links = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pending)).split())
        inside = len(" ".join(html.unescape("".join(in_link)).split()))
        pending.clear()
        in_link.clear()
        if text:
            leaf = Node("#")
            stack[-1][1].items.append(leaf)
            leaves.append(leaf)
            texts.append(text)
            linked.append(inside)

    at = 0
    for token in TOKEN.finditer(source):
        if token.start() > at:
            pending.append(source[at : token.start()])
            if links:
                in_link.append(pending[-1])
        at = token.end()
        name = token[5] or token[8]
        if not name:
            if token[2] and token[2].lower() == "xmp":
                flush()
                pending.append(html.escape(token[3] or ""))
                flush()
            elif token[2] and token[2].lower() == "svg" and token[3]:
                pending += [f" {MARKUP.sub(' ', inner)} " for inner in PICTURE_TEXT.findall(token[3])]
                pending.append(" ")
            elif token[1] or token[2]:
                pending.append(" ")
            continue
        tag = name.lower()
        if tag not in BLOCKS:
            if tag in BREAKS:
                pending.append(" ")
            elif tag == "a":
                links = max(0, links - 1) if token[4] or token[7] else 1
            continue
        flush()
        if token[4] or token[7]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        parent = stack[-1][1]
        label, path = _label(tag, token[6] or token[9] or ""), ()
        if len(stack) > DEPTH:
            path = stack[-1][2] or tuple(entry[1].label for entry in stack[1:])
            if not _matters(label, path):
                stack.append((tag, parent, path))
                continue
            path = (*path, label)
        node = Node(label)
        parent.items.append(node)
        stack.append((tag, node, path))
    if at < len(source):
        pending.append(source[at:])
    flush()
    # folding replaces nodes, so every text remembers its place by the labels around it
    _prune(root)
    numbers = {id(leaf): k for k, leaf in enumerate(leaves)}
    _mark(root, {id(leaf): (len(texts[k]), linked[k]) for k, leaf in enumerate(leaves)})
    expression = _folded(root)
    order = _places(root, expression, numbers)
    # folding keeps every text of the page, so each has a place
    return expression, [(order[k], texts[k], _is_prose(texts[k], linked[k])) for k in range(len(texts))]


def _mark(root: Node, sizes: dict[int, tuple[int, int]]) -> None:
    """Marks containers whose names or tag "form" say nothing, because the article is in them.

    These hold the main container of the page, the article or main element with the most text. On
    other pages and outside it they hold more than half of the page's text, less than half of that
    in links; comments and adverts may be longer than what they go with, so their names stand.
    """
    weights: dict[int, tuple[int, int]] = {}
    order: list[tuple[Node, Node | None]] = []
    pending: list[tuple[Node, Node | None]] = [(root, None)]
    while pending:
        node, above = pending.pop()
        order.append((node, above))
        pending += [(i, node) for i in node.items]
    parents = {id(node): above for node, above in order}
    for node, above in reversed(order):
        chars, links = sizes.get(id(node), (0, 0)) if node.label == "#" else weights.get(id(node), (0, 0))
        weights[id(node)] = (chars, links)
        if above is not None:
            sums = weights.get(id(above), (0, 0))
            weights[id(above)] = (sums[0] + chars, sums[1] + links)
    total = weights[id(root)][0]
    holds: set[int] = set()
    mains = [node for node, _ in order if _holds_article(node.label) and not _is_comment(node.label)]
    if mains:
        node: Node | None = max(mains, key=lambda n: weights[id(n)][0])
        while node is not None:
            holds.add(id(node))
            node = parents[id(node)]
    inside: set[int] = set()
    for node, above in order:
        if above is not None and (id(above) in inside or _holds_article(above.label)):
            inside.add(id(node))
        tag, names, role = _parts(node.label)
        if tag != "form" and role != "form" and not _aside_name(names):
            continue
        chars, links = weights[id(node)]
        never = any(NEVER_WORD.fullmatch(w) for words in _name_words(names) for w in words)
        most = 2 * chars > total and 2 * links < chars and not never and id(node) not in inside
        if id(node) in holds or most:
            node.label = "|".join([tag, names, role, "+"])


def _prune(node: Node) -> bool:
    """Drops elements without any text; they tell nothing apart."""
    node.items = [i for i in node.items if i.label == "#" or _prune(i)]
    return bool(node.items)


def _folded(node: Node) -> Node:
    return Node(node.label, items=_merge_runs([_folded(i) for i in node.items]))


def _places(node: Node, expression: Node, numbers: dict[int, int]) -> dict[int, int]:
    """For every text of a page tree the number of its slot in an expression that matches the tree."""
    for k, (slot, _, _) in enumerate(expression.slots()):
        slot.slot = k
    found: dict[int, int] = {}
    _match(node.items, expression.items, numbers, found)
    return found


def _match(items: list[Node], pattern: list[Node], numbers: dict[int, int], found: dict[int, int]) -> bool:
    """Walks the pattern with the items; every item takes the next part that matches all of it.

    An item may stay on a part, since it may be repeated, and a group begins anew where its labels
    return. An item that nothing matches is left out, and the answer is False.
    """
    flat = list(_flatten(pattern))
    places: dict[str, list[int]] = {}
    for k, part in enumerate(flat):
        places.setdefault(part.label, []).append(k)
    at, whole = 0, True
    for item in items:
        own = places.get(item.label, [])
        # parts from here on first, then those before
        start = bisect_left(own, at)
        for turn in range(len(own)):
            k = own[(start + turn) % len(own)]
            if item.label == "#":
                found[numbers[id(item)]] = flat[k].slot
                at = k
                break
            inner: dict[int, int] = {}
            if _match(item.items, flat[k].items, numbers, inner):
                found.update(inner)
                at = k
                break
        else:
            whole = False
    return whole


def _flatten(pattern: list[Node]) -> Iterator[Node]:
    for part in pattern:
        if part.label:
            yield part
        else:
            yield from _flatten(part.items)


def slot_map(expression: Node, wrapper: Node) -> list[int]:
    """For every slot of an expression the number of the wrapper's slot it falls into.

    A slot that alignment has put where the walk does not find it is judged by its labels alone:
    it gets its own rank, below ALONE, if no container above it decides against it, and NOWHERE otherwise.
    """
    slots = list(expression.slots())
    numbers = {id(leaf): k for k, (leaf, _, _) in enumerate(slots)}
    plain = Node("", items=list(_opened(expression.items)))
    found = _places(plain, wrapper, numbers)
    return [
        found.get(k, ALONE - _main_rank(path) if _verdict(path)[0] else NOWHERE) for k, (_, path, _) in enumerate(slots)
    ]


def _opened(items: list[Node]) -> Iterator[Node]:
    """The items with groups replaced by one round of theirs, all the way down; slots stay the same objects."""
    for item in items:
        if not item.label:
            yield from _opened(item.items)
        elif item.label == "#":
            yield item
        else:
            yield Node(item.label, items=list(_opened(item.items)))


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text_type = pa.list_(pa.struct([("leaf", pa.int32()), ("text", pa.string()), ("prose", pa.bool_())]))
    for batch in batches:
        shapes, blocks = [], []
        for source in batch["html"].to_pylist():
            expression, texts = read_page(source or "")
            shapes.append(json.dumps(expression.dump(), separators=(",", ":")))
            blocks.append([{"leaf": leaf, "text": text, "prose": prose} for leaf, text, prose in texts])
        yield pa.RecordBatch.from_arrays(
            [
                *[batch[c] for c in ("page_id", "url", "host")],
                pa.array(shapes, pa.string()),
                pa.array(blocks, text_type),
            ],
            names=["page_id", "url", "host", "shape", "blocks"],
        )


def _align_all(shapes: list[str]) -> str:
    wrapper = Node.load(json.loads(shapes[0]))
    for shape in shapes[1:]:
        wrapper = align(wrapper, Node.load(json.loads(shape)))
    return json.dumps(wrapper.dump(), separators=(",", ":"))


def _infer(rows: pd.DataFrame) -> pd.DataFrame:
    shapes = sorted(set(rows["shape"]), key=lambda s: (-len(s), s))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "shape": [_align_all(shapes)]})


def _place(shapes: pd.DataFrame, wrappers: pd.DataFrame) -> pd.DataFrame:
    """The places of some expressions of a host in its wrapper."""
    wrapper = Node.load(json.loads(wrappers["wrapper"].iloc[0]))
    slots = [slot_map(Node.load(json.loads(shape)), wrapper) for shape in shapes["shape"]]
    return pd.DataFrame({"host": shapes["host"], "shape_key": shapes["shape_key"], "slots": slots})


def _parts(label: str) -> tuple[str, str, str]:
    tag, names, role = (label.split("|") + ["", ""])[:3]
    return tag, names, role


def _marked(label: str) -> bool:
    return label.endswith("|+")


def _holds_article(label: str) -> bool:
    """Whether a container says by its tag or role that it holds the article."""
    tag, _, role = _parts(label)
    return tag in ("article", "main") or role in MAIN_ROLES


def _name_words(names: str) -> Iterator[list[str]]:
    """The words of every class and id that speaks of the container itself."""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z]+", name) if len(w) > 1]
        if words and words[0] not in MENTIONS:
            yield words


def _plain(words: list[str]) -> bool:
    return all(w in PLAIN_WORDS or ASIDE_WORD.fullmatch(w) for w in words)


def _aside_name(names: str) -> int:
    """What classes and ids say about a container: 2 that it holds something else than the article, 1 maybe, 0 nothing.

    A name says so if it consists of such words and of words that go along with them; with other
    words, or a doubtful word beside other names, it may mean something else.
    """
    if names not in _NAMES:
        words = list(_name_words(names))
        aside = [own for own in words if any(ASIDE_WORD.fullmatch(w) for w in own)]
        others = not all(map(_plain, words))
        sure = any(_plain(own) and not (others and all(w in DOUBTFUL for w in own)) for own in aside)
        _NAMES[names] = 2 if sure else int(bool(aside))
    return _NAMES[names]


def _is_comment(label: str) -> bool:
    return any(_plain(own) and any(COMMENT_WORD.fullmatch(w) for w in own) for own in _name_words(_parts(label)[1]))


def _is_aside(label: str) -> bool:
    """Whether a container may hold something else than the article."""
    tag, names, role = _parts(label)
    return tag in ASIDE or role in ASIDE_ROLES or (tag not in ("html", "body", "main") and _aside_name(names) > 0)


def _main_rank(path: tuple[str, ...]) -> int:
    """The kind of the outermost main container above a slot: 3 (an article) to 1, 0 if there is none."""
    for label in path:
        tag, names, role = _parts(label)
        if tag == "article" or role == "article":
            return 3
        if tag == "main" or role in MAIN_ROLES:
            return 2
        if tag in ("div", "section", "td") and MAIN_NAMES.search(names):
            return 1
    return 0


def _verdict(path: tuple[str, ...]) -> tuple[int, int]:
    """What the containers above a slot say: 2 that it is wanted, 0 that it is not, 1 that its texts have to tell.

    In the last case the second number is the place on the path of the container to be judged.
    """
    inside, vote = False, -1
    for k, label in enumerate(path):
        tag, names, role = _parts(label)
        if not _marked(label):
            if tag in ASIDE or role in ASIDE_ROLES:
                return 0, k
            said = 0 if tag in ("html", "body", "main") else _aside_name(names)
            if said == 2 and (not (inside or _holds_article(label)) or _is_comment(label)):
                return 0, k
            # inside the article a plain name is a vote, and one that may mean something else is none
            if vote < 0 and ((said == 2 and inside) or (said == 1 and not inside and not _holds_article(label))):
                vote = k
        inside = inside or _holds_article(label)
        # a header of the article itself has its title, and no more of it
        if tag == "header" and not (inside and _parts(path[-1])[0] in HEADINGS):
            return 0, k
    return (2, -1) if vote < 0 else (1, vote)


def _in_article(path: tuple[str, ...]) -> bool:
    """Whether a container above a slot says by its tag or role that it holds the article."""
    return any(map(_holds_article, path))


def _matters(label: str, path: tuple[str, ...]) -> bool:
    """Whether texts in a container are judged otherwise than those beside it; true a few times on a path."""
    tag = _parts(label)[0]
    if _is_aside(label):
        return not any(map(_is_aside, path))
    if tag == "header" or tag in HEADINGS:
        kind = ("header",) if tag == "header" else HEADINGS
        return not any(_parts(above)[0] in kind for above in path)
    return bool(_main_rank((label,))) and (not _main_rank(path) or (_in_article((label,)) and not _in_article(path)))


def rank_slots(wrapper: str, statistics: dict[int, tuple[int, int, int, int]]) -> list[int]:
    """For every slot of the wrapper the kind of its main container, -1 if it does not hold the article.

    ``statistics`` has, per slot, the pages with it, the pages that share its most frequent text,
    the characters of its texts and those of texts that are prose. A text outside repeated groups,
    articles and main elements that most pages share is the template's. A container whose name
    votes against it is left out if less than half of its text is prose of its own.
    """
    slots = []
    own: dict[int, list[int]] = {}
    for slot, (_, above, many) in enumerate(Node.load(json.loads(wrapper)).placed()):
        path = tuple(n.label for n in above)
        pages, same, chars, prose = statistics.get(slot, (0, 0, 0, 0))
        shared = same >= TEMPLATE_PAGES and 100 * same > TEMPLATE_PERCENT * pages
        verdict, at = _verdict(path)
        judged = id(above[at]) if verdict == 1 else 0
        if judged:
            sums = own.setdefault(judged, [0, 0])
            sums[0] += chars
            sums[1] += 0 if shared and not many else prose
        fixed = not many and shared and not _in_article(path)
        heading = bool(path) and _parts(path[-1])[0] in HEADINGS
        slots.append((verdict, judged, heading or not fixed, _main_rank(path), above))
    ranks = []
    for verdict, judged, varies, rank, _ in slots:
        wanted = verdict == 2 or (verdict == 1 and 2 * own[judged][1] >= own[judged][0])
        ranks.append(rank if wanted and varies else -1)
    return ranks


def _rank(rows: pd.DataFrame) -> pd.DataFrame:
    statistics = {
        int(r.slot): (int(r.pages), int(r.same), int(r.chars), int(r.prose)) for r in rows.itertuples() if r.slot == r.slot
    }
    ranks = rank_slots(rows["wrapper"].iloc[0], statistics)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "ranks": [ranks]})


def _put_into_wrappers(shapes: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, shape_key, slots): where the slots of every expression are in its host's wrapper.

    A host's expressions are dealt into parts of bounded size, and its wrapper goes to each once.
    """
    sizes = shapes.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / PLACED).cast("int").alias("parts"))
    sizes = materialize(sizes, "host-parts")
    dealt = shapes.join(sizes, "host").select(
        "host", F.pmod(F.xxhash64("shape_key"), F.col("parts")).cast("int").alias("part"), "shape", "shape_key"
    )
    sent = wrappers.join(sizes, "host").select(
        "host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("shape").alias("wrapper")
    )
    paired = dealt.groupBy("host", "part").cogroup(sent.groupBy("host", "part"))
    return paired.applyInPandas(_place, "host string, shape_key string, slots array<int>")


def infer_wrappers(shapes: DataFrame) -> DataFrame:
    """(host, shape): the wrapper of every host of ``shapes`` (host, shape), whose rows are distinct.

    Expressions of hosts with more than a block of them are dealt into blocks by hash, about half
    full, and each block gives its wrapper. That is repeated until no host has more than a block.
    """
    done = None
    for turn in itertools.count():
        sizes = shapes.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
        sizes = materialize(sizes, f"wrapper-sizes-{turn}")
        if sizes.isEmpty():
            break
        small = shapes.join(sizes, "host", "left_anti")
        done = small if done is None else done.unionByName(small)
        blocks = F.ceil(F.col("n") * 2 / BLOCK)
        part = F.pmod(F.xxhash64("shape", F.lit(turn)), blocks).alias("part")
        dealt = shapes.join(sizes, "host").select("host", "shape", part)
        aligned = dealt.groupBy("host", "part").applyInPandas(_infer, "host string, shape string")
        shapes = materialize(aligned.distinct(), f"wrappers-{turn}")
    rest = shapes if done is None else done.unionByName(shapes)
    return rest.groupBy("host").applyInPandas(_infer, "host string, shape string")


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    The text is the page's article: its blocks in page order, with character references decoded
    and white space inside a block turned into one space, joined by two line breaks.

    * Pages are grouped by the host of their url; NULL urls and urls without a host are one group.
    * NULL and empty html, and pages without any text, give an empty text. Tags that are not
      closed, or closed without being open, are repaired as far as blocks need it.
    * Copies of a page, pages with the same texts under any url, count once in the statistics of a
      host. Repeated rows get a row each.
    * A form that holds the main container or most of a page's text is a container like others;
      its controls are left out. Of an svg the text elements stay. Contents of audio, video, canvas
      and textarea elements, which browsers do not show as text, are left out.
    * An empty table gives no rows. Other columns are ignored.
    """
    url = F.col("url").cast("string")
    inputs = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    parsed = in_small_batches(inputs).mapInArrow(
        _parse_pages,
        "page_id long, url string, host string, shape string, blocks array<struct<leaf: int, text: string, prose: boolean>>",
    )
    parsed = materialize(parsed.withColumn("shape_key", F.sha2("shape", 256)), "parsed-pages")
    shapes = materialize(parsed.select("host", "shape", "shape_key").distinct(), "shapes")
    wrappers = materialize(infer_wrappers(shapes.select("host", "shape")), "wrappers")
    places = _put_into_wrappers(shapes, wrappers)
    places = materialize(places, "places")
    placed = parsed.drop("shape").join(places, ["host", "shape_key"])
    # array positions count from 0 in the lists
    block = F.transform(
        "blocks",
        lambda b: F.struct(F.get("slots", b["leaf"]).alias("slot"), b["text"].alias("text"), b["prose"].alias("prose")),
    )
    placed = placed.select("page_id", "url", "host", block.alias("blocks"))

    # copies of a page have all texts in common
    keys = [F.xxhash64("blocks.text").alias(KEY), F.hash("blocks.text").alias(CHECK)]
    # named before the blocks are exploded, or each of them would hash all texts of its page
    keyed = placed.select("host", *keys, "blocks")
    texts = keyed.select("host", KEY, CHECK, F.explode("blocks").alias("b")).select(
        "host", KEY, CHECK, F.col("b.slot").alias("slot"), F.xxhash64("b.text").alias("value"),
        F.char_length("b.text").cast("long").alias("chars"),
        F.when(F.col("b.prose"), F.char_length("b.text")).otherwise(0).cast("long").alias("prose"),
    )
    sums = [F.sum(c).alias(c) for c in ("chars", "prose")]
    # a repeated slot has several texts on a page; copies of a page have equal ones
    values = texts.groupBy("host", "slot", KEY, CHECK).agg(F.min("value").alias("value"), *sums)
    counted = values.groupBy("host", "slot", "value").agg(F.count(F.lit(1)).alias("n"), *sums)
    statistics = counted.groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("same"), *sums)
    known = wrappers.withColumnRenamed("shape", "wrapper").join(statistics, "host", "left")
    ranks = materialize(known.groupBy("host").applyInPandas(_rank, "host string, ranks array<int>"), "slots")

    def rank(block: Column) -> Column:
        known_slot = F.get("ranks", block["slot"])
        return F.when(block["slot"] <= ALONE, ALONE - block["slot"]).when(block["slot"] == NOWHERE, -1).otherwise(known_slot)

    def amount(kind: int) -> Column:
        """The length of a page's text in main containers of a kind."""
        own = F.filter("ranked", lambda b: b["rank"] == kind)
        return F.aggregate(own, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))

    # The kind of main container that holds most of a page's text is its article, all of it; a
    # page that has no text in such containers is one itself.
    ranked = placed.join(ranks, "host").withColumn(
        "ranked", F.transform("blocks", lambda b: F.struct(rank(b).alias("rank"), b["text"].alias("text")))
    )
    most = F.greatest(*[F.struct(amount(kind).alias("n"), F.lit(kind).alias("kind")) for kind in MAIN_RANKS])
    ranked = ranked.select("page_id", "url", "ranked", most.alias("most"))
    best = F.when(F.col("most.n") > 0, F.col("most.kind")).otherwise(0)
    ranked = ranked.select("page_id", "url", "ranked", best.alias("best"))
    kept = F.filter("ranked", lambda b: b["rank"] == F.col("best"))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    return (
        ranked.select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
