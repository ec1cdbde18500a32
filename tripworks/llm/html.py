"""Main text of web pages: a tree-structured graphical model over the nodes of the page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import exp, inf, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Pages, about, that teach the model beside the hand-labelled ones: those whose address has a small hash.
FIT_PAGES = 2_000
# Counts added to each outcome before probabilities are taken.
SMOOTH = 1.0

# Elements of HTML by what they do to text and to open elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hgroup hr main menu nav ol p pre section table ul li dd dt".split()
    ),
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
}
# What a head may hold; anything else ends it, with or without its end tag.
IN_HEAD = frozenset("title meta link script style base noscript template basefont bgsound".split())
# Raw elements that may stand in themselves, and of those the ones that may close themselves.
NESTED, FOREIGN = frozenset(["svg", "math", "template"]), frozenset(["svg", "math"])
# A form with one of these is a frame around a page, not a form to fill in.
FRAMED = frozenset("article main header footer nav h1".split())
# An end tag or new element closes nothing beyond these.
FENCE = frozenset("html body table td th article section aside nav main header footer div ul ol form blockquote".split())
# Never text of a page, whatever its neighbours are.
NEVER = frozenset("head form button select input textarea option datalist object canvas audio video map dialog".split()) | RAW

# Words in class, id and role that hint at what an element holds, first match wins.
HINTS = (
    ("comment", "comment comments reply replies discussion disqus respond"),
    ("advert", "ad ads advert advertisement adbox banner sponsor sponsored promo promoted"),
    ("notice", "cookie cookies consent notice alert gdpr popup modal newsletter subscribe signup paywall"),
    ("menu", "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc"),
    ("side", "side sidebar aside widget widgets related recommended rail complementary"),
    ("foot", "foot footer copyright legal contentinfo"),
    ("head", "header head masthead topbar logo banner"),
    ("share", "share sharing social tools toolbar meta byline tags"),
    ("body", "article content main body post entry story text"),
)
_HINT = {word: name for name, words in reversed(HINTS) for word in words.split()}

# A quote opens a value only right after the sign of equality; anywhere else it is a character like others.
_INSIDE = r"(?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+"
_MARKUP = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_INSIDE})(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Nodes in page order, each after its parent; node 0 is the page itself."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    hints: list[str] = field(default_factory=lambda: ["-"])
    parents: list[int] = field(default_factory=lambda: [-1])
    never: list[bool] = field(default_factory=lambda: [False])
    marks: list[str] = field(default_factory=lambda: [""])
    pieces: list[tuple[int, str]] = field(default_factory=list)  # node and its raw text; node -1: a block ends


def _hint(attributes: str) -> str:
    if "=" not in attributes:
        return "-"
    words = [w for m in _NAMES.finditer(attributes) for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
    return next((_HINT[w] for w in words if w in _HINT), "-")


def _raw_end(html: str, tag: str, at: int) -> int:
    """Where the content of a raw element that begins at ``at`` has ended, end tag included."""
    depth = 1
    pattern = rf"<(/?){re.escape(tag)}\b({_INSIDE})(?:>|\Z)" if tag in NESTED else rf"<(/){re.escape(tag)}\b([^>]*)(?:>|\Z)"
    for found in re.compile(pattern, re.I | re.S).finditer(html, at):
        if found[1]:
            depth -= 1
        elif not (tag in FOREIGN and found[2].endswith("/")):
            depth += 1
        if not depth:
            return found.end()
    return len(html)


def _unframed(page: Page) -> Page:
    """Forms that stand around a page are taken out of the tree; what they hold goes to their parents."""
    holds = [tag in FRAMED for tag in page.tags]
    for k in range(len(page.tags) - 1, 0, -1):
        holds[page.parents[k]] |= holds[k]
    frames = {k for k, tag in enumerate(page.tags) if tag == "form" and holds[k]}
    if not frames:
        return page
    for k in range(1, len(page.tags)):
        if page.parents[k] in frames:  # whose own parent is none by now
            page.parents[k] = page.parents[page.parents[k]]
        page.never[k] = page.tags[k] in NEVER or page.never[page.parents[k]]
    page.pieces = [(page.parents[node] if node in frames else node, raw) for node, raw in page.pieces]
    return page


def parse(html: str) -> Page:
    """A forgiving reader: any text gives some tree, in one pass and without recursion."""
    return _unframed(_tree(html))


def _tree(html: str) -> Page:
    page, at, here, stack = Page(), 0, 0, [0]
    tags, parents, never, pieces = page.tags, page.parents, page.never, page.pieces
    while True:
        found = _MARKUP.search(html, at)
        until = len(html) if found is None else found.start()
        if until > at:
            if tags[here] == "head" and not html[at:until].isspace():
                del stack[stack.index(here) :]
                here = stack[-1]
            pieces.append((here, html[at:until]))
        if found is None:
            return page
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag not in INLINE:
            pieces.append((-1, ""))
        if tags[here] == "head" and not found[1] and tag not in IN_HEAD:
            del stack[stack.index(here) :]
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] == tag:
                    del stack[k:]
                    break
                if tags[stack[k]] in FENCE and tag not in FENCE:
                    break
            here = stack[-1]
            continue
        for k in range(len(stack) - 1, 0, -1):
            open_tag = tags[stack[k]]
            if tag in CLOSED_BY.get(open_tag, ()):
                del stack[k:]
                break
            if open_tag in FENCE:
                break
        tags.append(tag)
        page.hints.append(_hint(found[3]))
        parents.append(stack[-1])
        never.append(never[stack[-1]] or tag in NEVER)
        page.marks.append(found[3] if "data-y" in found[3] else "")
        node = len(tags) - 1
        if tag in RAW:
            if not (tag in FOREIGN and found[0].endswith("/>")):
                at = _raw_end(html, tag, at)
        elif tag not in VOID and not found[0].endswith("/>"):
            stack.append(node)
        here = stack[-1]


def _bucket(n: float, *edges: float) -> int:
    return sum(n >= e for e in edges)


def features(page: Page) -> list[tuple[str, ...]]:
    """What is seen of each node: tag, hint, the nearest hint or region around it, and how much text it
    and all below it hold, how much of that links. Of inline nodes only the region: they are part of
    their parent's text, and a link or a bold word in a sentence is as good as the rest of it.
    """
    n = len(page.tags)
    text, signs, links = [0] * n, [0] * n, [0] * n
    for node, raw in page.pieces:
        if node >= 0 and not page.never[node]:
            text[node] += len(raw) - raw.count(" ")
            signs[node] += raw.count(".") + raw.count(",")
    for k in range(n - 1, 0, -1):
        if page.tags[k] == "a":
            links[k] = text[k]
        up = page.parents[k]
        text[up] += text[k]
        signs[up] += signs[k]
        links[up] += links[k]
    region = ["-"] * n
    for k in range(1, n):
        own = page.hints[k] if page.hints[k] != "-" else page.tags[k] if page.tags[k] in REGIONS else None
        region[k] = own or region[page.parents[k]]
    about = [() if r == "-" else (f"region {r}",) for r in region]
    return [
        about[k]
        if page.tags[k] in INLINE
        else (
            *about[k],
            f"tag {page.tags[k] if page.tags[k] in KNOWN else 'other'}",
            f"hint {page.hints[k]}",
            f"text {_bucket(text[k], 1, 20, 80, 400)}",
            f"links {_bucket(links[k], max(1, 0.2 * text[k]), max(1, 0.6 * text[k]))}",
            f"signs {_bucket(100 * signs[k], max(1, text[k]), max(1, 3 * text[k]))}",
        )
        for k in range(n)
    ]


# Elements that say what they hold, like a hint does.
REGIONS = frozenset("article main nav aside header footer".split())
KNOWN = CLOSED_BY["p"] | INLINE | frozenset("body html td th tr tbody dd dt #page".split())


def edge(page: Page, k: int) -> str:
    """Kind of the bond between a node and its parent: inline ones follow the parent more than blocks do."""
    return "inline" if page.tags[k] in INLINE else "block"


# Pages made up and labelled by hand: data-y=1 begins main text, data-y=0 what is not, and holds below.
LABELLED = [
    """<html><head><title>t</title></head><body data-y=0><div class="topbar">Call us today</div><header><h1>The Daily Paper</h1>
    <nav><ul><li><a href=/>Home</a></li><li><a href=/w>World</a></li></ul></nav></header><div class="cookie-notice"><p>We use cookies, and
    ask for your consent. Read on if you agree.</p><button>Accept</button></div><main data-y=1><article><h1>A long day</h1><p>The day was
    long, and the night was longer. Nobody knew why.</p><p>Yes.</p><blockquote><p>It was long, she said, and dark.</p></blockquote><ul><li>One
    thing to note, at last.</li><li>Another thing.</li></ul><div class="ad" data-y=0>Buy shoes, now cheaper.</div><p>At the end, there was
    <a href=/x>a link</a> and <b>some words</b>.</p></article></main><aside class="sidebar"><h3>Related</h3><ul><li><a href=/a>Other news</a></li></ul>
    <p>Most read this week.</p></aside><section id="comments"><h3>Comments</h3><div class="comment"><p>I liked it, thank you.</p></div><div class="comment">
    <p>Not for me. The text was long, and I did not read it.</p></div></section><form class="newsletter"><label>Mail</label><input></form><footer><p>Copyright, all
    rights reserved.</p><a href=/i>Imprint</a></footer></body></html>""",
    """<html><body data-y=0><div id="header"><a href=/>Logo</a><p class="slogan">News for all.</p></div><div id="menu"><a href=/1>One</a> <a href=/2>Two</a></div>
    <div id="content" data-y=1><h2>Bread at home</h2><p>Flour, water, salt and time. That is all it takes.</p><p>Wait a day.</p><table><tr><td>Flour</td><td>500 g</td></tr></table>
    <h3>Second step</h3><p>Knead it well, then let it rest, covered, in a warm place.</p><pre>bake 40 min</pre><div class="related" data-y=0><a href=/b>More recipes</a></div></div><div id="sidebar"><p>About
    the author. She bakes, and writes.</p></div><div class="promo"><p>Subscribe today, save half.</p></div><div id="footer">Contact, terms, privacy.</div></body></html>""",
    """<html><body data-y=0><nav class="breadcrumb"><a href=/>Home</a> / <a href=/f>Forum</a></nav><div class="notice">This site will be down on Sunday.</div><div class="post" data-y=1>
    <h1>How tall is it?</h1><div class="entry"><p>It is tall, very tall. I measured it twice, once in the rain.</p><p>Short one.</p><figure><img src=x><figcaption>The tower, seen
    from afar.</figcaption></figure><dl><dt>Height</dt><dd>Ninety metres, more or less.</dd></dl></div></div><div class="share"><a href=/t>Share</a></div><div class="comments"><ol><li><p>First!</p></li><li><p>I do
    not believe it, sorry. My uncle was there, and he said it was small.</p></li></ol></div><div class="ads"><p>Visit the tower, best price.</p></div><footer>About us</footer></body></html>""",
    """<html><body data-y=0><header class="masthead"><p>Since 1901, every day.</p><ul class="nav"><li><a href=/>Start</a></li></ul></header><section class="story" data-y=1><h1>Rain</h1><p>Rain
    fell, all day, on the hills and in the town.</p><section><h2>Later</h2><p>Then it stopped.</p><ol><li>Dry.</li><li>Warm, too.</li></ol></section><aside data-y=0><p>Read also: sun, wind
    and snow.</p></aside></section><div class="sponsored"><h4>Partner</h4><p>Umbrellas, for every taste. Order yours.</p></div><div class="widget"><p>Weather today: rain.</p></div><div class="pagination"><a href=/2>Next
    </a></div><footer><small>Made with care, in town.</small></footer></body></html>""",
    """<html><body data-y=0><ul><li><a href=/>Home</a></li><li><a href=/about>About me</a></li></ul><div data-y=1><h1>My boat</h1><p>I built a boat, of oak and
    pine, in four years. It floats, as a boat should, and it is blue.</p><p>It has one sail.</p><div><p>Inside, there is room for two, a stove, and a lamp.</p></div><ul><li>Length, six
    metres.</li><li>Weight, not known.</li></ul></div><p><a href=/2>Next page</a> <a href=/1>Last page</a></p><form>Search</form></body></html>""",
    """<html><body data-y=0><p data-y=1>A plain page, without any frame. It was written by hand, long ago, and nobody has changed it since.</p><h2 data-y=1>Then</h2><p data-y=1>There
    is more to read, for those who like to. The end is near, though.</p><table data-y=1><tr><td>Year, and day</td><td>Both are lost.</td></tr></table><p data-y=1>So it
    ends.</p><hr><p><a href=/up>Up</a> <a href=/top>Top</a></p></body></html>""",
]


def hand_labels(page: Page) -> list[int]:
    labels = [0] * len(page.tags)
    for k in range(1, len(page.tags)):
        mark = page.marks[k]
        labels[k] = int("data-y=1" in mark) if mark else labels[page.parents[k]]
    return labels


def plain_labels(page: Page) -> list[int] | None:
    """Labels that a page's own structure leaves no doubt about; None if it has none.

    With exactly one article, what is in it is main text, but for parts of it that HTML sets apart
    or that hints do; everything beside it is not.
    """
    if page.tags.count("article") != 1:
        return None
    labels = [0] * len(page.tags)
    for k in range(1, len(page.tags)):
        apart = page.never[k] or page.tags[k] in ("nav", "aside", "footer", "header") or page.hints[k] not in ("-", "body")
        labels[k] = int(not apart and (page.tags[k] == "article" or labels[page.parents[k]] == 1))
    return labels


def observations(page: Page, labels: list[int]) -> Iterator[tuple[str, int, int]]:
    """(what, label, given): bonds with the parent's label, features (given -1) with the node's own."""
    for k, seen in enumerate(features(page)):
        if k:
            yield f"edge {edge(page, k)}", labels[k], labels[page.parents[k]]
            for what in seen:
                yield what, labels[k], -1


@dataclass
class Model:
    """Probabilities of the tree: of a label given the parent's by kind of bond, log odds of features."""

    bonds: dict[str, tuple[float, float]]  # main text if the parent is not, if it is
    odds: dict[str, float]

    @classmethod
    def from_counts(cls, counts: dict[tuple[str, int, int], int]) -> Model:
        bonds, seen, totals = {}, {what for what, _, given in counts if given < 0}, {}
        for kind in ("edge inline", "edge block"):
            share = []
            for given in (0, 1):
                no, yes = (counts.get((kind, y, given), 0) + SMOOTH for y in (0, 1))
                share.append(yes / (no + yes))
            bonds[kind] = tuple(share)
        for (what, label, given), n in counts.items():
            if given < 0:
                group = (what.split(" ")[0], label)
                totals[group] = totals.get(group, 0) + n
        odds = {}
        for what in seen:
            group = what.split(" ")[0]
            kinds = sum(w.startswith(group + " ") for w in seen)
            share = [(counts.get((what, y, -1), 0) + SMOOTH) / (totals.get((group, y), 0) + SMOOTH * kinds) for y in (0, 1)]
            odds[what] = log(share[1] / share[0])
        return cls(bonds, odds)


def marginals(page: Page, model: Model) -> list[float]:
    """P(node is main text), given all of the page, by messages up the tree and down again.

    Node 0 is not main text, unless there is no other. Messages are ratios of "main text" to "not"; a child's message to its
    parent sums over the child's label, the parent's to the child takes the child's own part out.
    """
    n = len(page.tags)
    if n == 1:
        return [1.0]
    seen = features(page)
    bonds = [model.bonds[f"edge {edge(page, k)}"] for k in range(n)]
    local = [sum(model.odds.get(w, 0.0) for w in what) for what in seen]
    # own evidence, then times the messages from below
    belief = [0.0 if page.never[k] else exp(min(30.0, max(-30.0, local[k]))) for k in range(n)]
    up = [1.0] * n
    for k in range(n - 1, 0, -1):
        no, yes = bonds[k]
        message = (1 - yes + yes * belief[k]) / (1 - no + no * belief[k])
        up[k] = message
        belief[page.parents[k]] = min(max(belief[page.parents[k]] * message, 1e-200), 1e200) if not page.never[page.parents[k]] else 0.0
    found = [0.0] * n
    for k in range(1, n):
        parent = page.parents[k]
        above = found[parent]  # marginal of the parent; its part from this child is taken out
        rest = above / (1 - above) / up[k] if above < 1 else inf
        share = rest / (1 + rest) if rest != inf else 1.0
        no, yes = bonds[k]
        prior = share * yes + (1 - share) * no
        odds = belief[k] * prior / (1 - prior)
        found[k] = odds / (1 + odds) if odds != inf else 1.0
    return found


def main_text(page: Page, found: list[float]) -> str:
    """Text of the nodes that are more likely main text than not, block by block."""
    blocks: list[list[str]] = [[]]
    for node, raw in page.pieces:
        if node < 0:
            blocks.append([])
        elif found[node] >= 0.5 and not page.never[node]:
            blocks[-1].append(raw)
    texts = (" ".join(unescape("".join(b)).split()) for b in blocks if b)
    return " ".join(t for t in texts if t)


def count_labels(pages: DataFrame, html: str) -> DataFrame:
    """(what, label, given, n) over the pages whose structure labels them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                page = parse(text)
                labels = plain_labels(page)
                for key in observations(page, labels) if labels else ():
                    counts[key] = counts.get(key, 0) + 1
        columns = [list(c) for c in zip(*((*k, n) for k, n in counts.items()), strict=True)] or [[], [], [], []]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["what", "label", "given", "n"])

    found = pages.select(F.col(html).cast("string").alias("html")).mapInArrow(run, "what string, label int, given int, n bigint")
    return found.groupBy("what", "label", "given").agg(F.sum("n").alias("n"))


def fit(pages: DataFrame, url: str = "url", html: str = "html", most: int = FIT_PAGES) -> Model:
    """Counts over the hand-labelled pages and over about ``most`` of ``pages``, chosen by hash of address.

    Hand-labelled pages are as many observations as the sampled ones, so a single design of pages
    cannot drown them.
    """
    counts: dict[tuple[str, int, int], int] = {}
    known = pages.where(F.col(html).isNotNull())
    share = min(1.0, most / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64(url, F.length(html)), F.lit(1 << 30)) < int(share * (1 << 30)))
    for r in count_labels(sample.select(F.col(html).alias("html")), "html").collect():  # a few hundred kinds
        counts[(r["what"], r["label"], r["given"])] = r["n"]
    total = sum(counts.values())
    by_hand: dict[tuple[str, int, int], int] = {}
    for text in LABELLED:
        page = parse(text)
        for key in observations(page, hand_labels(page)):
            by_hand[key] = by_hand.get(key, 0) + 1
    weight = max(1, total // sum(by_hand.values()))
    for key, n in by_hand.items():
        counts[key] = counts.get(key, 0) + weight * n
    return Model.from_counts(counts)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", model: Model | None = None) -> DataFrame:
    """One row (page_id, url, text, n_chars) per row of ``pages``; the model is fitted unless given.

    Character references are decoded, white space within a block becomes one blank, blocks are joined
    by one. Null or empty html, or a page without main text, gives an empty text. Any markup is read,
    whole or broken, to its end. Ids and addresses may be null or repeat; other columns are not looked at.
    """
    fitted = model or fit(pages, url, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(2).to_pylist():
                page = parse(value or "")
                texts.append(main_text(page, marginals(page, fitted)))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
