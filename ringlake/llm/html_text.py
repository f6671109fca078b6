"""Main text of web pages by a tree-structured graphical model (operator 3).

A page's block elements and text runs are nodes of a tree with the states mixed, content and rest. Unary potentials
come from a softmax over each node's features, parent-child potentials from counted state pairs, both trained on
labelled pages. Sum-product messages go up the tree and down again; text runs whose content marginal passes one half
make the text. Parsing is lenient and takes time in proportion to the page: unclosed and misnested tags, comments and
unknown elements are all accepted, scripts end by the rules of HTML, and what is hidden gives no text.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm.linear import Adam
from ringlake.llm.spaces import table

MIXED, CONTENT, REST = 0, 1, 2
#: Fixed values of the HTML syntax.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("template noscript object svg math canvas select button audio video".split())
ENDED = frozenset("svg math select button canvas audio video".split())  # by a section that opens in them
SECTIONS = frozenset("article main section nav aside header footer h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPES = frozenset("ul ol dl table div section article aside nav header footer main form blockquote body td th".split())
#: What a tag closes besides itself stands at a known place of the stack under these keys.
KEYS = {t: (t, *(["scope"] if t in SCOPES else []), *(["list"] if t in ("ul", "ol", "dl", "table", "select") else [])) for t in SCOPES | {"select"}}
#: Attributes of a tag up to its end; no part is read twice, so that unclosed tags and quotes take linear time.
INSIDE = r"""(?>[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+)*+"""
PIECE = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)({INSIDE})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>"'][^\s>]*+))?+)?+""")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
SCRIPT = re.compile(r"<!--(?:-?>)?|-->|<(/?)script(?=[\s/>]|\Z)", re.I)
HIDES = re.compile(r"hidden|display|visibility", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
DEEPEST = 512  # further elements become siblings, as in browsers; their text stays


@dataclass
class Page:
    """Nodes in page order: parent, tag, attribute words, and for text runs their text and linked share."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)
    state: list[str] = field(default_factory=list)

    def add(self, parent: int, tag: str, names: list[str], text: str | None = None, linked: float = 0.0, state: str = "") -> int:
        for to, x in ((self.parent, parent), (self.tag, tag), (self.names, names), (self.text, text), (self.linked, linked), (self.state, state)):
            to.append(x)
        return len(self.parent) - 1


class Open:
    """The open elements. ``at`` has the places of each tag and kind, so that no search walks the stack."""

    def __init__(self):
        self.tags, self.nodes = ["body"], [0]
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str, node: int) -> None:
        for k in KEYS.get(tag, (tag,)):
            self.at.setdefault(k, []).append(len(self.tags))
        self.tags.append(tag)
        self.nodes.append(node)

    def cut(self, to: int) -> None:
        for tag in self.tags[to:]:
            for k in KEYS.get(tag, (tag,)):
                self.at[k].pop()
        del self.tags[to:], self.nodes[to:]

    def last(self, *keys: str) -> int:
        """Place of the innermost of the tags or kinds; 0 without one."""
        return max((self.at[k][-1] for k in keys if self.at.get(k)), default=0)

    def closed_by(self, tag: str) -> int:
        """Place of the outermost element that an opening tag ends; 0 without one."""
        p = self.last("p") if tag in CLOSES_P else 0
        p = p if p > self.last("scope") else 0
        if tag in CLOSED_BY:
            edge = self.last("list")
            return min((x for x in (p, *map(self.last, CLOSED_BY[tag])) if x > edge), default=p)
        return p


def raw_end(source: str, tag: str, at: int, strict: bool) -> tuple[int, bool]:
    """Where the text of a script, style ... ends, and whether its end tag is there.

    ``strict``: in a script, an end tag inside ``<!-- <script`` does not count."""
    depth = 0
    for m in SCRIPT.finditer(source, at) if tag == "script" and strict else RAW_END[tag].finditer(source, at):
        if tag != "script" or not strict or m[1] == "/" and depth < 2:
            return PIECE.match(source, m.start()).end(), True
        if m[1] is None:
            depth = 0 if m[0].endswith(">") else max(depth, 1)
        else:
            depth = 1 if m[1] else 2 if depth else 0
    return len(source), False


def parse(source: str) -> Page:
    """The page's tree. A closing tag without its opening one is skipped; whatever is open at the end is closed.

    Hidden elements, and those that hold no text of the page, say nothing up to their end or that of an element around.
    """
    page = Page()
    page.add(-1, "body", [])
    depth, stack = [0], Open()
    run: list[str] = []
    links, in_link = [0, 0], 0
    at, muted, strict = 0, 0, True  # muted: place of the outermost silent element

    def flush():
        nonlocal run, links
        if run:
            words = html.unescape("".join(run)).split()
            if words:
                page.add(stack.nodes[-1], "#text", [], " ".join(words), links[1] / max(1, links[0]))
                depth.append(0)
            run, links = [], [0, 0]

    def say(s: str):
        if s and not muted:
            run.append(s)
            n = len(s) - s.count(" ")
            links[0] += n
            links[1] += n * (in_link > 0)

    def cut(to: int):
        nonlocal muted
        stack.cut(to)
        muted = 0 if to <= muted else muted

    while m := PIECE.search(source, at):
        say(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            own = stack.last(tag)
            if muted and own >= muted:
                cut(own)
                continue
            if muted and (own == 0 or tag in INLINE):
                continue
            if tag == "a":
                in_link = 0
            if tag in INLINE or tag in VOID or tag in ("html", "head"):
                if tag == "br":
                    flush()
                continue
            flush()
            if own and (tag != "p" or own > stack.last("scope")):
                cut(own)
            in_link = 0 if tag != "p" else in_link
            continue
        if tag in RAW:
            start = at
            at, ended = raw_end(source, tag, start, strict)
            if not ended and tag == "script" and strict:  # rather than to lose the rest of the page
                strict = False
                at, _ = raw_end(source, tag, start, strict)
            continue
        if tag in ("html", "head", "body"):
            if not muted:
                flush()
            if tag == "body" and m[3]:
                page.names[0] += words_of(m[3])[0]
            continue
        if tag in VOID:
            if tag in ("br", "hr") and not muted:
                flush()
                if tag == "hr" and (to := stack.closed_by(tag)):
                    cut(to)
            continue
        inline = tag in INLINE or tag in DROPPED  # these stand inside a line of text
        names, state, hidden = words_of(m[3]) if m[3] and (not inline or HIDES.search(m[3])) else ([], "", False)
        if muted and (around := stack.tags[muted]) in ENDED:
            if tag in SECTIONS or around in ("svg", "math") and tag in CLOSES_P and stack.last("foreignobject") <= muted:
                cut(muted)
        if not inline and (to := stack.closed_by(tag)):
            if not muted or to <= muted:
                flush()
            cut(to)
        if muted or hidden or tag in DROPPED:
            if m[3].endswith("/") and (inline or muted):
                continue
            if not muted:
                if not inline:
                    flush()
                muted = len(stack.tags)
            stack.push(tag, stack.nodes[-1])
            continue
        if inline:
            if tag == "a":  # links do not nest; a mere anchor is none
                in_link = int("href" in m[3].lower())
            continue
        flush()
        above = stack.nodes[-1]
        if depth[above] >= DEEPEST:
            above = page.parent[above]
        stack.push(tag, page.add(above, tag, names, state=state))
        depth.append(depth[above] + 1)
    say(source[at:])
    flush()
    return page


def words_of(attributes: str) -> tuple[list[str], str, bool]:
    """Words of class, id and role, the label of a training page, and whether the element is hidden."""
    out, state, hidden = [], "", False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            out += [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value)]
        elif name == "data-state":
            state = value
        elif name == "hidden":
            hidden |= value.lower() != "until-found"
        elif name == "style":
            hidden |= UNSEEN.search(value) is not None
    return out, state, hidden


BITS = 14
#: Tags that set their part of a page apart, and words of a part's heading that say what it is.
PARTS = frozenset("nav aside footer form header dialog figure table article main section".split())
HEADINGS = frozenset("comments comment responses replies reply discussion feedback kommentare commentaires comentarios share related newsletter cookies cookie subscribe advertisement sponsored popular trending navigation menu search".split())


@lru_cache(1 << 14)
def within(word: str) -> tuple[str, ...]:
    """Known words that a name begins or ends with."""
    return tuple(k for k in LONG_WORDS if word.startswith(k) or word.endswith(k))


def features(page: Page) -> list[list[int]]:
    """Hashed features of every node: its own tag, names, length and share of links; what the parts around it are; how it stands to the page's
    article. Sums of text run up once, from the last node to the first, and surroundings down once."""
    n = len(page.parent)
    size, linked, texts, kids, head = [0] * n, [0.0] * n, [0] * n, [0] * n, [""] * n
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if page.text[i] is not None:
            size[i] = len(page.text[i])
            linked[i] = page.linked[i] * size[i]
            texts[i] = 1
            told = HEADINGS.intersection(page.text[i].lower().split()) if size[i] < 40 else ()
            head[i] = min(told) if told else ""
        size[p] += size[i]
        linked[p] += linked[i]
        texts[p] += texts[i]
        kids[p] += 1
        head[p] = head[i] if i == p + 1 or not head[p] and i <= p + 2 else head[p]  # the first run in it
    known = [KNOWN_WORDS.intersection(ws) | {k for w in ws if w not in KNOWN_WORDS for k in within(w)} if ws else frozenset() for ws in page.names]
    apart = [False] * n  # in a part whose name says that it is not the article
    for i in range(1, n):
        apart[i] = apart[page.parent[i]] or bool(known[i] & REST_WORDS) and size[i] < 0.9 * size[0]  # else it is a frame of the whole page
    own = [page.tag[i] for i in range(n) if page.tag[i] in ("article", "main") and not apart[i]]
    kind = "article" if "article" in own else "main" if own else "named" if any(ws & MAIN_WORDS for ws in known) else "none"
    part, inside, named, mood = ["body"] * n, [""] * n, [frozenset()] * n, [""] * n
    first = next((i for i in range(n) if page.tag[i] in ("article", "main") and not apart[i]), 0)
    around = {first}  # names of what holds the article say nothing about it
    while first > 0:
        first = page.parent[first]
        around.add(first)
    out = []
    for i in range(n):
        p, tag, run = page.parent[i], page.tag[i], page.text[i] is not None
        if i:
            part[i], inside[i], named[i], mood[i] = part[p], inside[p], named[p], mood[p]
            if tag in PARTS:
                part[i] = f"{tag}.{part[p]}" if tag in ("header", "section", "table", "figure") else tag
                part[i] = ".".join(part[i].split(".")[:3])
            if tag in ("article", "main"):
                inside[i] += tag[0] if len(inside[i]) < 3 else ""
            own = known[i]
            if own and i not in around:
                named[i] = named[p] | own
                mood[i] = "main" if own & MAIN_WORDS and not own & REST_WORDS else "rest" if own & REST_WORDS else mood[p]
        mark = "#" if run else ""
        density = linked[i] / size[i] if size[i] else 0.0
        long_, links = min(8, size[i].bit_length() - 3), int(density * 4)
        f = [f"t:{tag}", f"p:{page.tag[p] if p >= 0 else '^'}:{mark}", f"l:{mark}{long_}", f"d:{links}:{mark}", f"o:{kind}:{inside[i]}:{mark}", f"g:{part[i]}:{kind}:{inside[i]}", f"x:{links}:{kind}:{inside[i]}:{part[i]}", f"gt:{part[i]}:{tag}", f"y:{long_}:{kind}:{inside[i]}", f"b:{mood[i]}:{inside[i]}:{mark}", f"b:{mood[i]}"]
        f += [f"a:{w}" for w in sorted(named[i])]
        if head[i]:
            f += [f"w:{mark}", f"w:{head[i]}"]
        if run:
            f.append(f"k:{page.tag[p]}:{min(3, kids[p])}")
        else:
            f.append(f"m:{int((size[i] / texts[i]) ** 0.5 / 3) if texts[i] else -1}")
            f.append(f"k:{tag}:{min(3, kids[i])}")
            f += [f"n:{w}" for w in page.names[i]]
        out.append([slot(x) for x in f])
    return out


@lru_cache(1 << 16)
def slot(x: str) -> int:
    h = 2166136261
    for c in x.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return h >> (32 - BITS) ^ (h & ((1 << BITS) - 1))


@dataclass
class Model:
    weight: np.ndarray  # (features, states)
    pair: np.ndarray  # log potential of (parent state, own state)


class Forest:
    """Nodes of many pages in one array, by depth, for messages over all trees at once."""

    def __init__(self, pages: list[Page]):
        self.first = np.cumsum([0, *(len(p.parent) for p in pages)])
        parent = np.concatenate([np.array(p.parent) + b * (np.array(p.parent) >= 0) for p, b in zip(pages, self.first, strict=False)]) if pages else np.zeros(0, int)
        self.parent, self.depth = parent, np.zeros(len(parent), int)
        for i, p in enumerate(parent.tolist()):
            if p >= 0:
                self.depth[i] = self.depth[p] + 1
        rows = [f for p in pages for f in features(p)]
        self.node = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.feature = np.array([x for r in rows for x in r], int)
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(self.depth))[:-1]) if len(order) else []

    def unary(self, weight: np.ndarray) -> np.ndarray:
        z = np.stack([np.bincount(self.node, weights=weight[self.feature, s], minlength=len(self.parent)) for s in range(3)], 1)
        return z - _lse(z)[:, None]

    def marginals(self, model: Model) -> np.ndarray:
        """Sum-product: inward messages from the leaves, then outward ones from the root; log marginals of all nodes."""
        up = self.unary(model.weight)
        sent = np.zeros_like(up)
        for level in self.levels[:0:-1]:
            sent[level] = _lse(model.pair[None] + up[level][:, None, :])
            np.add.at(up, self.parent[level], sent[level])
        out = up.copy()
        for level in self.levels[1:]:
            above = out[self.parent[level]] - sent[level]
            down = _lse((model.pair[None] + above[:, :, None]).swapaxes(1, 2))
            out[level] = up[level] + down - _lse(up[level] + down)[:, None]
        if len(self.levels):
            out[self.levels[0]] -= _lse(out[self.levels[0]])[:, None]
        return out


def _lse(z: np.ndarray) -> np.ndarray:
    top = z.max(-1, keepdims=True)
    return (top + np.log(np.exp(z - top).sum(-1, keepdims=True)))[..., 0]


def states(page: Page) -> np.ndarray:
    """Labels of a training page: runs take the nearest ``data-state`` above them, elements what all runs below share."""
    n = len(page.parent)
    own = [""] * n
    for i in range(n):
        own[i] = page.state[i] or (own[page.parent[i]] if i else "rest")
    has = np.zeros((n, 2), bool)
    for i in range(n - 1, -1, -1):
        if page.text[i] is not None:
            has[i, int(own[i] == "content")] = True
        if i:
            has[page.parent[i]] |= has[i]
    return np.where(has.all(1), MIXED, np.where(has[:, 1], CONTENT, REST))


def train(pages: list[str], rounds: int = 120, rate: float = 0.15, shrink: float = 2e-5) -> Model:
    """Unary weights by softmax regression on node labels, pair potentials from counts of label pairs against chance."""
    parsed = [parse(p) for p in pages]
    forest = Forest(parsed)
    y = np.concatenate([states(p) for p in parsed])
    weight = np.zeros((1 << BITS, 3))
    step = Adam([weight], rate)
    one = np.eye(3)[y]
    for _ in range(rounds):
        g = (np.exp(forest.unary(weight)) - one) / len(y)
        step.step([np.stack([np.bincount(forest.feature, weights=g[forest.node, s], minlength=1 << BITS) for s in range(3)], 1) + shrink * weight])
    kid = np.flatnonzero(forest.parent >= 0)
    count = np.full((3, 3), 0.5)
    np.add.at(count, (y[forest.parent[kid]], y[kid]), 1)
    joint = count / count.sum()
    return Model(weight, np.log(joint / joint.sum(1)[:, None] / joint.sum(0)[None]))


def extract(pages: list[str | None], model: Model, at_least: float = 0.5) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    forest = Forest(parsed)
    content = np.exp(forest.marginals(model)[:, CONTENT]) > at_least
    return ["\n".join(t for t, keep in zip(p.text, content[a : a + len(p.parent)], strict=True) if keep and t) for p, a in zip(parsed, forest.first.tolist(), strict=False)]


def main_text(pages: DataFrame, model: Model, id_col: str = "page_id", html_col: str = "html", block_bytes: int = 1 << 21) -> DataFrame:
    """``(id, text, n_chars)`` for every row: whole pages, nothing capped. Pages are held in blocks of about ``block_bytes``.

    The key may be any column, a struct too. Null, empty and textless pages give an empty text; hidden elements, scripts and
    comments give none, and what an unclosed tag or comment holds to the page's end is no text, as in browsers. Repeated rows and null ids keep their row, an empty table gives
    no rows, other columns are ignored.
    """
    key = pages.select(id_col).schema[0].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            edge = np.flatnonzero(np.diff(np.cumsum(size + 1) // block_bytes, prepend=-1))  # a block more with each so many bytes
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                texts = extract(part.column(1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "text", "n_chars"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).mapInArrow(scan, f"id {key.simpleString()}, text string, n_chars bigint")


#: Names that training pages give to their regions.
CONTENT_NAMES = "content article post entry story main body text page-content article-body post-content entry-content story-body prose".split()
REST_NAMES = {
    "nav": "nav menu navbar navigation main-menu breadcrumb breadcrumbs pagination topbar toc".split(),
    "header": "header masthead site-header banner branding logo top".split(),
    "footer": "footer site-footer copyright bottom legal colophon".split(),
    "aside": "sidebar aside widget related related-posts recommended popular trending side-column".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad sponsor adsbox".split(),
    "notice": "notice cookie cookie-notice cookie-banner consent alert gdpr popup modal newsletter subscribe signup paywall".split(),
    "form": "form search search-form login contact-form subscribe-form".split(),
    "comments": "comments comment-list comment comment-body reader-comments responses respond replies discussion thread disqus feedback".split(),
    "share": "share social social-links share-buttons byline-share tags meta-links".split(),
}
MAIN_WORDS = frozenset(w for name in CONTENT_NAMES for w in name.split("-")) - {"page", "main", "body", "text"}
REST_WORDS = frozenset(w for names in REST_NAMES.values() for name in names for w in name.split("-")) - MAIN_WORDS - {"page", "main", "body", "text", "content", "list", "links", "top"}
KNOWN_WORDS = frozenset(w for names in (CONTENT_NAMES, *REST_NAMES.values()) for name in names for w in name.split("-"))
LONG_WORDS = sorted(w for w in KNOWN_WORDS if len(w) > 3)
#: Alphabets of training pages; the last is written without spaces.
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz"] * 4 + ["абвгдежзиклмнопрстуфхцчшыэюя", "αβγδεζηθικλμνξοπρστυφχψω", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "一二三人大小中国上下天地日月山水火木金土年時生学"]


def labelled_pages(n: int = 600, seed: int = 1) -> list[str]:
    """Training pages of many layouts, drawn by rule; ``data-state`` marks content and rest.

    Articles hold lists of links, forms and comments, some are one short line, some stand in writing without spaces; sites have plain
    headers before their article, parts without names, and names that say nothing.
    """
    rng = random.Random(seed)
    letters = ALPHABETS[0]

    def words(a: int, b: int) -> str:
        gap = "" if letters is ALPHABETS[-1] else " "
        return gap.join("".join(rng.choice(letters) for _ in range(rng.randint(1, 11 if gap else 3))) for _ in range(rng.randint(a, b))) + rng.choice(["", ".", "."])

    def odd_name() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7)))

    def attrs(names: list[str], state: str = "", often: float = 0.85, told: float = 0.8) -> str:
        out = f' data-state="{state}"' if state else ""
        if rng.random() < often:
            name = rng.choice(names) if rng.random() < told else odd_name()
            out += rng.choice([f' class="{name}"', f' id="{name}"', f" class={name}", f' class="{name} {rng.choice(["box", "wrap", "col", "block", "clearfix", odd_name()])}"'])
        return out

    def links(k: int) -> str:
        one = rng.choice(["<li>{}</li>", "{}", "<p>{}</p>", "<div>{}</div>", "<span>{}</span> "])
        return "".join((one if rng.random() < 0.9 else "<li>{}</li>").format(f'<a href="/x">{words(1, 4)}</a>') for _ in range(k))

    def paragraphs(lo: int, hi: int) -> str:
        out = ""
        for _ in range(rng.randint(lo, hi)):
            r = rng.random()
            if r < 0.66:
                n = rng.choice([(1, 4), (5, 20), (20, 90), (20, 90)])
                t = words(*n)
                if rng.random() < 0.25:
                    t = t.replace(" ", f' <a href="/y">{words(1, 3)}</a> ', 1)
                elif rng.random() < 0.06:
                    t = f'<a href="/y">{t}</a>'
                out += rng.choice([f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br>", f"<div>{t}</div>", f"<p><em>{t}</em></p>", f"{t}<br>", f"<section><h2>{words(1, 5)}</h2><p>{t}</p></section>"])
            elif r < 0.74:
                out += f"<h{(k := rng.randint(2, 4))}>{words(1, 8)}</h{k}>"
            elif r < 0.86:
                tag = rng.choice(["ul", "ul", "ol"])
                item = lambda: f'<a href="/z">{words(1, 6)}</a>' + rng.choice(["", f" {words(1, 9)}"])
                linked = rng.random() < 0.5
                out += f"<{tag}>" + "".join(f"<li>{item() if linked and rng.random() < 0.9 else words(1, 20)}</li>" for _ in range(rng.randint(1, 7))) + f"</{tag}>"
            elif r < 0.9:
                out += f"<blockquote>{rng.choice(['<p>{}</p>', '{}']).format(words(5, 40))}</blockquote>"
            elif r < 0.94:
                out += "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 6)}</td></tr>" for _ in range(rng.randint(1, 5))) + "</table>"
            elif r < 0.97:
                out += f"<pre><code>{words(3, 20)}</code></pre>"
            else:
                out += f"<figure><img src='x'><figcaption>{words(3, 15)}</figcaption></figure>"
        return out

    def comments(tag: str, names: list[str], state: str, told: float) -> str:
        one = [f'<{(t := rng.choice(["div", "li", "article"]))}{attrs(names, told=told)}><{(q := rng.choice(["p", "h4", "span", "div", "b"]))}>{words(1, 3)}</{q}><p>{words(2, 60)}</p></{t}>' for _ in range(rng.randint(1, 5))]
        title = f"<h3>{rng.choice([words(1, 3), 'Comments', '3 Comments', 'Responses', 'Leave a reply', 'Discussion'])}</h3>"
        form = f"<form><textarea></textarea><label>{words(1, 2)}</label><button>{words(1, 1)}</button></form>"
        return f"<{tag}{attrs(names, state, 1.0, told)}>{rng.choice(['', title, title])}{''.join(one)}{rng.choice(['', form])}</{tag}>"

    def rest(kind: str) -> str:
        names, state = REST_NAMES[kind], "rest"
        if kind == "nav":
            tag = rng.choice(["nav", "nav", "div", "ul"])
            inner = f"<ul>{links(rng.randint(1, 9))}</ul>" if tag != "ul" else links(rng.randint(1, 9))
        elif kind == "header":
            tag = rng.choice(["header", "header", "div"])
            inner = f"<{(h := rng.choice(['h1', 'h1', 'div', 'p', 'h2']))}>{words(1, 5)}</{h}>" + rng.choice(["", f"<p>{words(2, 9)}</p>", links(rng.randint(0, 5))])
        elif kind == "footer":
            tag = rng.choice(["footer", "footer", "div"])
            inner = rng.choice([f"&copy; {words(1, 3)} &middot; {words(1, 12)}", f"<p>&copy; {words(2, 14)}</p>{links(rng.randint(0, 6))}", f"<p>{words(2, 30)}</p>"])
        elif kind == "aside":
            tag = rng.choice(["aside", "aside", "div", "section"])
            inner = rng.choice(["", f"<h3>{words(1, 4)}</h3>"]) + rng.choice([f"<ul>{links(rng.randint(1, 7))}</ul>", links(rng.randint(1, 3)), paragraphs(1, 3)])
        elif kind == "ad":
            tag, inner = rng.choice(["div", "div", "aside", "section"]), rng.choice([words(2, 40), f"<p>{words(2, 40)}</p>", f'<a href="/b">{words(2, 12)}</a>'])
        elif kind == "notice":
            tag, inner = rng.choice(["div", "section", "p", "aside", "dialog"]), words(4, 40) + rng.choice(["", f' <a href="/c">{words(1, 2)}</a>', f"<button>{words(1, 2)}</button>"])
        elif kind == "form":
            tag = rng.choice(["form", "form", "form", "div"])
            field_ = lambda: rng.choice([f"<label>{words(1, 4)}</label><input name=q>", f"<p>{words(1, 5)} <input name=q></p>", f"<div><label>{words(1, 4)} <input></label></div>"])
            inner = "".join(field_() for _ in range(rng.randint(1, 4))) + rng.choice(["", words(0, 12)]) + f"<button>{words(1, 1)}</button>"
        elif kind == "share":
            tag, inner = rng.choice(["div", "ul", "p"]), links(rng.randint(1, 5))
        else:
            return comments(rng.choice(["section", "div", "ol", "aside"]), names, state, 0.9)
        own = tag in ("nav", "footer", "aside", "form", "header", "dialog")
        return f"<{tag}{attrs(names, state, 0.5 if own else 1.0, 0.8 if own else 1.0)}>{inner}</{tag}>"

    out = []
    for _ in range(n):
        letters = rng.choice(ALPHABETS)
        kinds = lambda pool, hi: [rest(rng.choice(pool)) for _ in range(rng.randint(0, hi))]
        inside = paragraphs(1, 14) if rng.random() < 0.7 else rng.choice([f"<p>{words(1, 12)}</p>", f"<p>{words(3, 30)}</p>" + paragraphs(0, 2)])
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):  # rest amid the article
            inside += rest(rng.choice(["ad", "share", "notice", "aside", "form", "form", "nav"])) + paragraphs(1, 3)
        if rng.random() < 0.18:
            inside += rest("comments")
        title = rng.choice(["", f"<h1>{words(1, 12)}</h1>", f"<h1>{words(1, 12)}</h1>"])
        if rng.random() < 0.25:
            title = f"<header>{title or f'<h1>{words(2, 9)}</h1>'}</header>"
        tag = rng.choice(["article", "article", "article", "main", "main", "div", "section", "td"])
        body = f"<{tag}{attrs(CONTENT_NAMES, 'content', 0.5 if tag in ('article', 'main') else 1.0, 0.8 if tag in ('article', 'main') else 1.0)}>{title}{inside}</{tag}>"
        body = f"<table><tr>{body}</tr></table>" if tag == "td" else body
        if tag == "article" and rng.random() < 0.35:
            body = f"<main{attrs(CONTENT_NAMES, '', 0.3)}>{rng.choice(['', rest('nav'), rest('notice')])}{body}{rng.choice(['', '', rest('aside'), rest('comments'), rest('share')])}</main>"
        if rng.random() < 0.06:
            body = f'<div data-state="content">{title}{inside}</div>'
        parts = [*kinds(["nav", "header", "header", "notice", "ad", "form"], 4), body, *kinds(["comments", "footer", "footer", "aside", "share", "nav", "ad", "notice"], 4)]
        text = "".join(parts)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            wrap = rng.choice(["div", "div", "section", "x-" + rng.choice("abcd")])
            text = f"<{wrap}{attrs(['wrapper', 'container', 'page', 'site', 'layout'])}>{text}</{wrap}>"
        out.append(f"<html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body>{text}</body></html>")
    return out


def op3_tree_model_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text(pages.select(F.struct("page_id", "url").alias("key"), "html"), train(labelled_pages()), "key")
    return found.select("id.page_id", "id.url", "text", "n_chars")
