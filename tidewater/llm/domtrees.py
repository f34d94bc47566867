"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed into its element tree. Every element that holds text gets features: tag, attribute tokens of itself and of its
ancestors, depth, text and link density of its subtree and of its own text, place among its siblings. Gradient-boosted
trees (logistic loss, histogram splits), trained here on generated pages whose elements are labelled, give each element the
log-odds of being main text. Decoding is hierarchical: for every subtree the better of ``all``, ``none`` and ``by child`` is chosen
from the leaves up, so that no element is kept within a dropped one nor dropped within a kept one; ``by child`` has a cost, so that a
few weak odds don't tear a kept article apart.

Blocks are block-level elements' own runs of text. Character references are decoded, white space within a block becomes one
space, blocks come in page order, one line each.

Pages are read in time linear in their length, however they are nested or broken, and scored in slices of so many elements.

Defined cases: null and empty pages and pages without main text give an empty text; unclosed and stray tags are repaired as browsers
do for paragraphs, list items, table cells and the head, others end with their parent; a quote counts in a tag only where a value begins,
and not if nothing closes it; where quotes would keep a tag from ending, they are plain characters from there on; what begins like a tag
but never ends is text; a slash closes void and foreign elements only; text outside any element belongs to the body; what is never
shown as text and what belongs to forms (``UNSEEN``) is no text; repeated rows are extracted one by one; columns besides page_id, url
and html are not read.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe head title select option textarea button".split())
FOREIGN = frozenset("svg math".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins del kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body article section div nav aside header footer main form blockquote".split())
TAGS = "p div li a span h1 h2 h3 h4 article section main nav header footer aside form ul ol table td blockquote pre figure figcaption body dd".split()
#: Parts of class, id and role values; the trees learn what each says.
HINTS = (
    "content article post story entry main body text page blog news read prose chapter lead "
    "nav menu header footer foot side sidebar bar aside ad ads advert banner sponsor promo notice cookie consent alert popup modal overlay newsletter subscribe signup login form search "
    "comment comments discussion reply replies respond thread disqus user related more recommend popular trending share social tags breadcrumb crumbs pager pagination widget meta author byline date copyright legal skip toolbar top links list toc"
).split()
NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
#: One step within a tag: its end, or an attribute and what its value begins with.
STEP = re.compile(r"[ \t\n\f\r/]*+(?:(>)|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:([\"'])|[^ \t\n\f\r>]*+))?+)")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
RAW = {t: re.compile(rf"</{t}(?=[ \t\n\f\r/>])", re.I) for t in ("script", "style", "noscript", "textarea", "title", "iframe")}
SPACE = re.compile(r"[\s ]+")
HINT = {h: 1 << i for i, h in enumerate(HINTS)}


class Page:
    """Elements of a page in document order, and runs of text with the element they are in. Linear in the source, however it is nested."""

    def __init__(self, source: str):
        self.tag, self.parent, self.hints, self.truth = ["body"], [-1], [0], [None]
        self.runs: list[tuple[int, str]] = []
        self.open, self.at, self.scopes, self.unseen, self.headed = [0], {}, [0], 0, False
        for m in iter_tokens(source):
            if m[0] == "text":
                if self.tag[self.open[-1]] == "head" and not m[1].isspace():
                    self._end("head")
                if not self.unseen:
                    self.runs.append((self.open[-1], m[1]))
            elif m[1]:
                self._end(m[2])
            elif m[2] == "body":
                self._end("head")
                self.truth[0] = self.truth[0] or self._truth(m[3])
            elif m[2] != "html":
                self._begin(m[2], m[3])
        del self.open, self.at, self.scopes

    @staticmethod
    def _truth(attributes: str) -> str | None:
        """Whether a generated page says that an element is main text."""
        found = re.search(r'data-truth="(.)"', attributes)
        return found[1] if found else None

    def _close(self, k: int) -> None:
        """Closes the open elements from the k-th on."""
        for node in reversed(self.open[k:]):
            tag = self.tag[node]
            self.at[tag].pop()
            self.unseen -= tag in UNSEEN
        del self.open[k:]
        while self.scopes[-1] >= k:
            self.scopes.pop()

    def _end(self, tag: str) -> None:
        places = self.at.get(tag)
        # A closing inline or paragraph tag never closes a container.
        if places and not (places[-1] < self.scopes[-1] and (tag in INLINE or tag == "p")):
            self._close(places[-1])

    def _begin(self, tag: str, attributes: str) -> None:
        if tag == "head":
            if self.headed:
                return
            self.headed = True
        elif self.tag[self.open[-1]] == "head" and tag not in IN_HEAD:
            # Body content ends the head.
            self._end("head")
        if tag not in INLINE:
            # A block ends an open paragraph, and list items and cells end their like, up to the nearest container.
            ended = []
            for t in ("p", *CLOSES.get(tag, ())):
                places = self.at.get(t, ())
                k = bisect_right(places, self.scopes[-1])
                ended += places[k : k + 1]
            if ended:
                self._close(min(ended))
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        hints, truth = 0, None
        if attributes and not attributes.isspace():
            values = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
            for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(v for k, v in values.items() if k in ("class", "id", "role", "itemprop", "aria-label"))).lower()):
                hints |= HINT.get(w, 0)
            truth = self._truth(attributes)
        self.hints.append(hints)
        self.truth.append(truth)
        if tag == "br":
            self.runs.append((self.open[-1], " "))
        foreign = tag in FOREIGN or any(self.at.get(t) for t in FOREIGN)
        if tag not in VOID and not (foreign and attributes.rstrip().endswith("/")):
            if tag in SCOPES:
                self.scopes.append(len(self.open))
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.unseen += tag in UNSEEN


def _tag_end(source: str, at: int, plain: set[str]) -> int:
    """Place of the > that ends a tag, those in quoted values left out; -1: none. plain: quotes that nothing closes any more."""
    end = source.find(">", at)
    if end < 0 or source.find('"', at, end) < 0 and source.find("'", at, end) < 0:
        return end
    place = at
    while m := STEP.match(source, place):
        place = m.end()
        if m[1]:
            return place - 1
        if m[2] and m[2] not in plain:
            close = source.find(m[2], place)
            if close < 0:
                plain.add(m[2])
            else:
                place = close + 1
    # Only quotes can hide an end that is there. This happens once in a page.
    plain.update("\"'")
    return end


def iter_tokens(source: str) -> Iterator[tuple]:
    """Texts and tags in page order. What begins like a tag but has no end is text, as is all after it."""
    at = place = 0  # at: where the text that is not given out yet begins
    plain: set[str] = set()
    while (place := source.find("<", place)) >= 0:
        begin, kind, tag = place, source[place + 1 : place + 2], None
        if source.startswith("<!--", place):
            found = COMMENT_END.search(source, place + 2)
            end = found.end() if found else len(source)
        elif source.startswith("<![CDATA[", place):
            end = source.find("]]>", place + 9)
            end = end + 3 if end >= 0 else len(source)
        elif kind in ("!", "?"):
            end = source.find(">", place) + 1
        elif name := NAME.match(source, place + 1 + (kind == "/")):
            end, tag = _tag_end(source, name.end(), plain) + 1, name[0].lower()
        else:
            place += 1
            continue
        if not end:
            break
        if begin > at:
            yield "text", html.unescape(source[at:begin])
        at = place = end
        if tag:
            yield "tag", kind == "/", tag, source[name.end() : end - 1]
            if kind != "/" and tag in RAW:
                found = RAW[tag].search(source, at)
                at = place = found.start() if found else len(source)
    if at < len(source):
        yield "text", html.unescape(source[at:])


def _bits(masks: list[int], width: int) -> np.ndarray:
    """Rows of 0 and 1 from numbers of so many bits."""
    size = -(-width // 8)
    raw = np.frombuffer(b"".join([m.to_bytes(size, "little") for m in masks]), np.uint8).reshape(-1, size)
    return np.unpackbits(raw, axis=1, count=width, bitorder="little")


class Described:
    """Features of a page's elements: numbers as columns, sets as bit masks; ``matrix`` lays out a range of rows."""

    def __init__(self, page: Page):
        n, parent = len(page.tag), page.parent
        index = {t: i for i, t in enumerate(TAGS)}
        kind = [index.get(t, len(TAGS)) for t in page.tag]
        depth, in_link, block, nth, kids, like = [0] * n, [False] * n, list(range(n)), [0] * n, [0] * n, [0] * n
        self.hint, self.above, self.tags_above = page.hints, [0] * n, [0] * n
        seen: dict[tuple[int, str], int] = {}
        for i in range(1, n):
            p, tag = parent[i], page.tag[i]
            depth[i] = depth[p] + 1
            in_link[i] = in_link[p] or tag == "a"
            if tag in INLINE:
                block[i] = block[p]
            nth[i] = kids[p]
            kids[p] += 1
            like[i] = seen[p, tag] = seen.get((p, tag), 0) + 1
            self.tags_above[i] = self.tags_above[p] | 1 << kind[p]
            self.above[i] = self.above[p] | self.hint[p]
        own, linked, stops = [0] * n, [0] * n, [0] * n
        for i, text in page.runs:
            size = len(text.strip())
            if size:
                own[i] += size
                stops[i] += text.count(".") + text.count(",")
                if in_link[i]:
                    linked[i] += size
        total, links, elements, marks = own.copy(), linked, [1] * n, stops
        for i in range(n - 1, 0, -1):
            p = parent[i]
            total[p] += total[i]
            links[p] += links[i]
            elements[p] += elements[i]
            marks[p] += marks[i]
        up = np.array(parent)
        up[0] = 0
        kind, depth, nth, like, kids, own, total, links, elements, marks = (np.array(x, float) for x in (kind, depth, nth, like, kids, own, total, links, elements, marks))
        page_text, some = max(total[0], 1), np.maximum(total, 1)
        named, within = (np.array([m.bit_count() for m in masks], float) for masks in (self.hint, self.above))
        self.columns = np.stack([kind, kind[up], kind[up[up]], named, named[up], within, depth, nth, like, kids, kids[up], np.log1p(own), np.log1p(total), total / page_text, links / some, np.log1p(total / elements), marks / some * 100, np.log1p(total[up]), links[up] / some[up], np.log1p(total[up] / elements[up]), np.arange(n) / n], 1).astype(np.float32)
        self.block, self.total, self.own = block, total, own

    def __len__(self) -> int:
        return len(self.own)

    def matrix(self, a: int = 0, b: int | None = None) -> np.ndarray:
        sets = [_bits(m[a:b], w) for m, w in ((self.tags_above, len(TAGS) + 1), (self.hint, len(HINTS)), (self.above, len(HINTS)))]
        return np.concatenate([self.columns[a:b], *sets], 1, dtype=np.float32)


#: Levels of a tree, trees, and percentage of the features that one tree may use.
DEPTH, ROUNDS, FEATURES = 5, 200, 35


class Trees:
    """Gradient-boosted trees of fixed depth for a logistic loss, over binned features."""

    def __init__(self, depth: int = DEPTH, rounds: int = ROUNDS, rate: float = 0.25, bins: int = 24):
        self.depth, self.rounds, self.rate, self.bins = depth, rounds, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        self.useful = [k for k, c in enumerate(x.T) if c.min() != c.max()]
        b = self.binned(x)
        score, leaves = np.full(len(y), self.base), 1 << self.depth
        self.feature, self.cut, self.value = [], [], []
        draw = np.random.default_rng(7)
        for _ in range(self.rounds):
            some = draw.permutation(self.useful)[: -(-len(self.useful) * FEATURES // 100)]
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(leaves, np.int64), np.full(leaves, 255)
            for level in range(self.depth):
                first, width = 1 << level, 1 << level
                gain, pick = np.zeros(width), [(0, 255)] * width
                for k in some.tolist():
                    cell = node * self.bins + b[:, k]
                    gs = np.bincount(cell, g, width * self.bins).reshape(width, -1).cumsum(1)
                    hs = np.bincount(cell, h, width * self.bins).reshape(width, -1).cumsum(1)
                    gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                    value = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    best = value.argmax(1)
                    for i in range(width):
                        if value[i, best[i]] > gain[i] + 1e-9:
                            gain[i], pick[i] = value[i, best[i]], (k, int(best[i]))
                for i in range(width):
                    feature[first + i if level else 1], cut[first + i if level else 1] = pick[i]
                node = 2 * node + (b[np.arange(len(y)), feature[first + node]] > cut[first + node])
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + 1)
            score += value[node]
            self.feature.append(feature), self.cut.append(cut), self.value.append(value)
        return self

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        b, rows = np.zeros(x.shape, np.uint8), np.arange(len(x))
        for k in np.unique(np.concatenate(self.feature)):
            b[:, k] = np.searchsorted(self.edges[k], x[:, k], "left")
        out = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) + node
                node = 2 * node + (b[rows, feature[at]] > cut[at])
            out += value[node]
        return out


def generated(n: int, seed: int = 3) -> Iterator[str]:
    """Pages with main text marked data-truth="1" and everything else "0", of many layouts.

    The main text has an element of its own, with or without a name, or stands between the other parts of the body, as blocks or as text;
    end tags and whole tags that HTML lets out are left out of some pages.
    """
    r = random.Random(seed)
    syllables = [a + b for a in "b d f k l m n p r s t v".split() for b in "a e i o u an er".split()]

    def words(k: int) -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(k))

    def sentence() -> str:
        return words(r.randint(1, 18)).capitalize() + r.choice("...!?")

    def paragraph() -> str:
        return " ".join(sentence() for _ in range(r.choice((1, 1, 2, 3, 5, 8))))

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(r.randint(1, 4))}</a></li>' for _ in range(k)) + "</ul>"

    def boiler() -> str:
        kind = r.choice(("nav", "menu", "header", "footer", "side", "ad", "notice", "form", "comments", "related", "share", "line", "noscript"))
        if kind == "line":
            tag = r.choice(("p", "div", "center"))
            return f'<{tag} data-truth="0">' + r.choice((" | ", " ", " &middot; ")).join(f'<a href="/{k}">{words(r.randint(1, 2))}</a>' for k in range(r.randint(2, 7))) + f"</{tag}>"
        if kind == "noscript":
            return f'<noscript data-truth="0">{r.choice((sentence(), f"<p>{sentence()}</p>"))}</noscript>'
        cls = {
            "nav": ("nav", "navbar", "navigation nav"), "menu": ("menu", "main-menu", "top-links"), "header": ("header", "page-header", "site-header top"), "footer": ("footer", "site-footer", "legal copyright"), "side": ("sidebar", "side-bar", "widget"),
            "ad": ("ad", "ads", "advert", "ad-banner", "sponsor promo"), "notice": ("cookie-notice", "notice", "alert banner", "consent popup"), "form": ("newsletter", "subscribe signup", "search", "login"),
            "comments": ("comments", "comment-list", "discussion", "replies thread", "user-comments"), "related": ("related", "related-posts more", "recommend popular"), "share": ("share social", "tags", "breadcrumb", "pager pagination"),
        }[kind]
        tag = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind, "div")
        tag = r.choice((tag, tag, "div", "section")) if kind != "form" else tag
        name = f' {r.choice(("class", "class", "id"))}="{r.choice(cls)}"' if tag == "div" or r.random() < 0.6 else ""
        if tag == "section" and not name:
            name = f' class="{r.choice(cls)}"'
        if kind in ("nav", "menu", "related", "share"):
            inner = links(r.randint(2, 12))
        elif kind == "comments":
            c = r.choice(("comment", "comment-body", "reply", "user-comment"))
            inner = (f"<h3>{words(2)}</h3>" if r.random() < 0.5 else "") + "".join(f'<{t} class="{c}"><p>{paragraph()}</p></{t}>' for t in ["div" if r.random() < 0.6 else "li"] for _ in range(r.randint(1, 8)))
        elif kind == "form":
            inner = f"<label>{words(2)}</label><input name='q'>" + (f"<p>{sentence()}</p>" if r.random() < 0.5 else "") + "<button>Go</button>"
        elif kind == "header":
            inner = r.choice((f"<h1>{words(3)}</h1>", f"<p>{words(4)}</p>", f"<div>{words(3)}</div>", words(4))) + (links(4) if r.random() < 0.4 else "")
        else:
            inner = r.choice((sentence(), f"<p>{paragraph()}</p>", f"<p>{sentence()}</p><p>{paragraph()}</p>", f"<div>{paragraph()}</div>", f"<h3>{words(2)}</h3>{links(3)}", f"&copy; {words(2)} &middot; {sentence()}"))
        return f'<{tag}{name} data-truth="0">{inner}</{tag}>'

    def media() -> str:
        tag = r.choice(("video", "object", "svg", "audio", "canvas"))
        return f"<figure><{tag}>{words(3)}</{tag}><figcaption>{sentence()}</figcaption></figure>"

    def blocks() -> list[str]:
        parts = [f"<h1>{words(r.randint(1, 8))}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice((1, 1, 2, 4, 8, 16))):
            few = words(r.randint(1, 4)).capitalize() + "."
            parts.append(r.choice((f"<p>{paragraph()}</p>",) * 7 + (f"<p>{few}</p>", f"<p><b>{few}<br>", f"<p>{paragraph()}<br>{sentence()}</p>", f"<p><b>{paragraph()}<br>", f"<h2>{words(3)}</h2>", f"<blockquote>{paragraph()}</blockquote>", "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(4)) + "</ul>", f'<p>{sentence()} <a href="/y">{words(2)}</a> {sentence()}</p>', f"<pre>{words(9)}</pre>", f"<div>{paragraph()}</div>",
                media(), f"<p>{sentence()}<noscript>{words(3)}</noscript></p>", f"<table><tr><td>{sentence()}<td>{sentence()}<tr><td>{words(2)}</table>")))
        return parts

    def main() -> str:
        shape, parts = r.choice(("article", "article", "main", 'div class="content"', 'div id="content"', 'div class="post-body entry"', 'section class="story text"', 'div class="article"', "div")), blocks()
        if r.random() < 0.25:
            parts.insert(r.randrange(len(parts) + 1), boiler())
        return f'<{shape} data-truth="1">{"".join(parts)}</{shape.split()[0]}>'

    def bare() -> str:
        """Blocks without an element around them."""
        return "".join(re.sub(r"^<(\w+)", r'<\1 data-truth="1"', part) for part in blocks())

    for _ in range(n):
        before, after = [boiler() for _ in range(r.randint(0, 4))], [boiler() for _ in range(r.randint(0, 4))]
        layout, own = r.random(), ""
        if layout < 0.55:
            body = "".join(before) + main() + "".join(after)
            if r.random() < 0.5:
                body = f'<div class="{r.choice(("wrapper", "page", "container", "site main"))}">{body}</div>'
        elif layout < 0.9:
            body = "".join(before) + bare() + "".join(after)
            if r.random() < 0.3:
                body = f'<div class="{r.choice(("wrapper", "page", "container", "outer"))}">{body}</div>'
        else:
            own = ' data-truth="1"'
            body = "".join(before) + r.choice(("<br>", "<br><br>", "<hr>")).join(paragraph() for _ in range(r.randint(1, 5))) + "".join(after)
        if r.random() < 0.3:
            body = re.sub("</(p|li)>", "", body)
        head = f"<title>{words(3)}</title><style>p{{}}</style>"
        form = r.random()
        if form < 0.5 or own:
            yield f"<html><head>{head}</head><body{own}>{body}<script>x('</p>')</script></body></html>"
        elif form < 0.65:
            yield f"<!doctype html><html><head><meta charset=utf-8>{head}<body>{body}"
        elif form < 0.8:
            yield f"<!doctype html>{head}{body}<script src=x></script>"
        elif form < 0.9:
            yield f"<html lang=en><head>{head}<link rel=stylesheet href=x></head>{body}</html>"
        else:
            yield f"<body>{body}</body>"


#: Elements that are scored at once.
SCORED = 1 << 14
#: Generated pages that the trees are trained on.
TRAINING_PAGES = 1200
#: What a choice by child costs against one for the whole subtree.
SPLIT_COST = 2.0


def train(pages: int = TRAINING_PAGES) -> Trees:
    xs, ys = [], []
    for source in generated(pages):
        page = Page(source)
        d = Described(page)
        truth = list(page.truth)
        mixed = [False] * len(truth)
        for i in range(1, len(truth)):
            truth[i] = truth[i] if truth[i] is not None else truth[page.parent[i]]
        for i in range(len(truth) - 1, 0, -1):
            p = page.parent[i]
            mixed[p] = mixed[p] or mixed[i] or truth[i] != truth[p]
        # Of what holds both kinds, only elements with text of their own say something. Links and list items are many and alike: one in six will do.
        ok = [i for i in range(len(truth)) if truth[i] is not None and d.total[i] > 0 and (not mixed[i] or d.own[i] > 0) and (i % 6 == 0 or page.tag[i] not in INLINE and page.tag[i] != "li")]
        xs.append(d.matrix()[ok])
        ys.append(np.array([truth[i] == "1" for i in ok], float))
    return Trees().fit(np.concatenate(xs), np.concatenate(ys))


def decoded(page: Page, odds: np.ndarray, total: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which elements' own text is kept: the best choice of all, none or by child, for every subtree at once."""
    n, parent = len(page.tag), page.parent
    everything = np.where(total > 0, odds * np.log1p(own), 0.0)
    whole = (np.where(total > 0, odds, 0.0) + everything).tolist()
    split = (np.where(own > 0, np.abs(everything), 0.0) - SPLIT_COST).tolist()
    filled, own_odds = (total > 0).tolist(), odds.tolist()
    for i in range(n - 1, 0, -1):
        if filled[i]:
            whole[parent[i]] += whole[i]
            split[parent[i]] += max(abs(whole[i]), split[i])
    keep = np.zeros(n, bool)
    state = [0] * n  # 0 by child, 1 all, 2 none: settled above
    for i in range(n):
        s = state[parent[i]] if i else 0
        if not s and filled[i]:
            s = 0 if split[i] > abs(whole[i]) else (1 if whole[i] > 0 else 2)
        state[i] = s
        keep[i] = s == 1 or s == 0 and own_odds[i] > 0
    return keep


def text_of(page: Page, keep: np.ndarray, block: np.ndarray) -> str:
    lines, last, parts = [], None, []
    # A new block begins where the block element changes.
    for i, text in page.runs:
        if not keep[i]:
            continue
        if block[i] != last:
            lines.append("".join(parts))
            parts, last = [], block[i]
        parts.append(text)
    lines.append("".join(parts))
    return "\n".join(s for s in (SPACE.sub(" ", x).strip() for x in lines) if s)


def _texts(sources: list[str], trees: Trees) -> Iterator[str]:
    """Main texts. So many pages at once as have SCORED elements, and of a longer one so many rows."""
    def flush(waiting: list[tuple[Page, Described]]) -> Iterator[str]:
        d = [x for _, x in waiting]
        if len(d) == 1:
            odds = np.concatenate([trees.scores(d[0].matrix(a, a + SCORED)) for a in range(0, len(d[0]), SCORED)])
        else:
            odds = trees.scores(np.concatenate([x.matrix() for x in d]))
        start = 0
        for page, x in waiting:
            keep = decoded(page, odds[start : start + len(x)], x.total, x.own)
            start += len(x)
            yield text_of(page, keep, x.block)

    waiting, size = [], 0
    for source in sources:
        page = Page(source)
        if waiting and size + len(page.tag) > SCORED:
            yield from flush(waiting)
            waiting, size = [], 0
        waiting.append((page, Described(page)))
        size += len(page.tag)
    if waiting:
        yield from flush(waiting)


def extracted(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks."""
    trees = trees or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = list(_texts([s or "" for s in part.column("html").to_pylist()], trees))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars", "n_blocks"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")
