"""Main text of web pages by a minimum cut.

The page's blocks of text are the nodes of a graph. A block's cost of being
called content or boilerplate is the capacity of its edge to the one or the
other terminal; neighbours in page order and in the document tree are joined by
smoothness edges. The blocks on the content side of a minimum cut are the main
text.
"""

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import types as T

from creditloom.llm.workers import map_batches

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea iframe".split())
INLINE = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr audio canvas noscript object video "
    "math annotation maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
    "svg circle clippath defs desc ellipse filter g line lineargradient marker mask path pattern polygon polyline "
    "radialgradient rect stop symbol text textpath tspan use"
).split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog button select fieldset datalist head title".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
BOILER_WORDS = frozenset((
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended popup modal "
    "overlay newsletter subscribe signup login widget toolbar pagination pager copyright legal skip topbar"
).split())
CONTENT_WORDS = frozenset("article content main post entry story articlebody maintext prose".split())

# Words that name boilerplate outside an article, but inside it may name a part of the text.
UNSURE_WORDS = frozenset("alert header legal login notice notices related recommended side signup skip".split())

# Costs in units of log odds; the sign of a block's sum tells which terminal it leans to.
BIAS, IN_ARTICLE, CONTENT_NAME, BOILER, UNSURE = -0.5, 4.0, 1.5, 16.0, 5.0
LINKS, LINKS_IN_ARTICLE, SHORT, SENTENCE, PER_WORD, MOST_WORDS = -4.0, -1.5, -0.7, 0.7, 0.08, 2.5
NEXT_BLOCK, SAME_PARENT = 0.8, 0.4
FAR = 64  # steps in the tree; blocks further apart are joined as weakly as at this distance

_OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_NAME_END = re.compile(r"[\s/>]")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+")
_SENTENCE_END = re.compile(r"[.!?…。？！:;][\"'»”)\]]*\Z")
_CLOSES = {  # an element that a new one of the given kind closes, and where the search for it ends
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


class _Element:
    __slots__ = ("tag", "parent", "depth", "article", "boiler", "unsure", "named", "link")

    def __init__(self, tag, parent, article=False, boiler=False, unsure=False, named=False, link=False):
        self.tag, self.parent, self.article, self.boiler, self.unsure = tag, parent, article, boiler, unsure
        self.named, self.link = named, link
        self.depth = parent.depth + 1 if parent else 0


def _opened(tag, attributes, parent):
    """The element of a start tag, with what it and its ancestors say about content."""
    article = parent.article or tag in ("article", "main")
    boiler = parent.boiler or tag in BOILER_TAGS or tag == "header" and not parent.article
    named, unsure = parent.named, parent.unsure
    if attributes.strip():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        role = found.get("role", "").lower()
        article = article or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
        boiler = boiler or role in BOILER_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        boiler = boiler or "display:none" in found.get("style", "").replace(" ", "").lower()
        if tag not in ("html", "body", "main") and ("class" in found or "id" in found):
            parts = set(_NAME_PART.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
            good, bad = parts & CONTENT_WORDS, parts & BOILER_WORDS
            named = named or bool(good and not bad)
            # <article class="post comment"> is a comment; <div class="content-with-sidebar"> holds the content.
            comment = parts & {"comment", "comments", "commentlist", "reply", "replies"}
            if bad and not good and tag != "article":
                doubtful = parent.article and bad <= UNSURE_WORDS
                unsure, boiler = unsure or doubtful, boiler or not doubtful
            boiler = boiler or bool(comment)
    return _Element(tag, parent, article, boiler, unsure, named, parent.link or tag == "a")


class _Block:
    __slots__ = ("at", "text", "link_chars", "heading")

    def __init__(self, at, text, link_chars, heading):
        self.at, self.text, self.link_chars, self.heading = at, text, link_chars, heading


class _Tags:
    """Finds tags in one pass: no part of the page is read again for a ``<`` that turns out to be text."""

    def __init__(self, html):
        self.html, self.ends, self.stops, self.failed = html, (0, -1), (0, -1), set()

    def _next(self, pattern, known, at):
        """Where the pattern is next found from ``at`` on, the page's length if nowhere; starts only grow."""
        if not known[0] <= at <= known[1]:
            m = pattern.search(self.html, at)
            known = (at, m.start() if m else len(self.html))
        return known

    def tag(self, at):
        """(name, attributes, end) of the tag whose name starts at ``at``, None if it has no end.

        A ``>`` between quotes is part of an attribute.
        """
        html, size = self.html, len(self.html)
        self.ends = self._next(_NAME_END, self.ends, at)
        start = i = self.ends[1]
        walked = []
        while True:
            if not self.stops[0] <= i <= self.stops[1]:
                self.stops = self._next(_STOP, self.stops, i)
            stop = self.stops[1]
            if stop == size or stop in self.failed:
                break
            if html[stop] == ">":
                return html[at:start].lower(), html[start:stop], stop + 1
            walked.append(stop)
            i = html.find(html[stop], stop + 1) + 1
            if not i:
                break
        self.failed.update(walked)
        return None


class _Stack:
    """Open elements, with the places of each kind, so that none is searched for."""

    def __init__(self):
        self.elements, self.places, self.blocks = [_Element("", None)], {}, [0]

    def top(self):
        return self.elements[-1]

    def holder(self):
        """The innermost open element that is not inline."""
        return self.elements[self.blocks[-1]]

    def last(self, *tags):
        """The place of the innermost open element of these kinds, 0 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, element):
        self.places.setdefault(element.tag, []).append(len(self.elements))
        if element.tag not in INLINE:
            self.blocks.append(len(self.elements))
        self.elements.append(element)

    def close(self, place):
        while len(self.elements) > place:
            self.places[self.elements.pop().tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()


def blocks_of(html):
    """The blocks of text of a page in page order, each with the element that holds it.

    A ``<`` that starts no whole tag is text. The work grows in proportion to the page.
    """
    stack, tags, blocks, pieces, links = _Stack(), _Tags(html), [], [], 0
    holder = stack.top()

    def close_block():
        nonlocal pieces, links
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append(_Block(holder, text, links, re.fullmatch("h[1-6]", holder.tag) is not None))
        pieces, links = [], 0

    def add(text):
        nonlocal links, holder
        if not text:
            return
        text = unescape(text)
        if not pieces:
            holder = stack.holder()
        pieces.append(text)
        if stack.top().link:
            links += len(text.strip())

    def after(end, start):
        found = html.find(end, start)
        return len(html) if found < 0 else found + len(end)

    read, at, endless = 0, 0, set()  # text is added up to ``read``, tags are looked for from ``at`` on
    while m := _OPENING.search(html, at):
        start, kind = m.start(), m[0]
        if kind[1] in "!?":
            add(html[read:start])
            end = after({"<!--": "-->", "<![CDATA[": "]]>"}.get(kind, ">"), m.end())
            if kind == "<![CDATA[":
                add(html[m.end():end].removesuffix("]]>"))
            read = at = end
            continue
        found = tags.tag(m.end() - 1)
        if not found:
            at = m.end()
            continue
        add(html[read:start])
        tag, attributes, at = found
        read = at
        if kind[1] == "/":
            if tag == "br":
                add(" ")
                continue
            place = stack.last(tag)
            if tag not in INLINE:
                close_block()
            if place and not (tag in INLINE and stack.blocks[-1] > place):
                stack.close(place)
            continue
        alone = attributes.rstrip().endswith("/")
        if tag in RAW:
            if not alone and tag not in endless:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                if end:
                    read = at = end.start()
                else:
                    endless.add(tag)
            continue
        if tag in VOID:
            if tag in ("br", "wbr"):
                add(" " if tag == "br" else "")
            elif tag == "hr":
                close_block()
            continue
        if tag not in INLINE:
            close_block()
            kinds, within = _CLOSES.get(tag, (("p",), ()))
            place = stack.last(*kinds)
            if place > stack.last(*within):
                stack.close(place)
        if not alone or tag not in INLINE:
            stack.push(_opened(tag, attributes, stack.top()))
    add(html[read:])
    close_block()
    return blocks


def leaning(block):
    """Log odds of a block being content, from its own text and the elements around it."""
    e, words = block.at, len(block.text.split())
    score = BIAS + min(MOST_WORDS, PER_WORD * words)
    score += SENTENCE if _SENTENCE_END.search(block.text) else SHORT if words < 5 and not block.heading else 0.0
    density = min(1.0, block.link_chars / len(block.text))
    if density > 0.5:
        score += density * (LINKS_IN_ARTICLE if e.article else LINKS)
    if e.article:
        score += IN_ARTICLE
    if e.named:
        score += CONTENT_NAME
    if e.unsure:
        score -= UNSURE
    return score - BOILER if e.boiler else score


def _tree_distance(a, b):
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(lean, edges):
    """Nodes on the content side of a minimum cut.

    ``lean``: positive leaning is the capacity from the content terminal,
    negative the one to the boilerplate terminal. ``edges``: (i, j, capacity),
    both directions. Shortest augmenting paths in layers.
    """
    n = len(lean)
    source, sink = n, n + 1
    head, to, cap = [[] for _ in range(n + 2)], [], []

    def add(u, v, forth, back):
        head[u].append(len(to))
        to.append(v)
        cap.append(forth)
        head[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i, x in enumerate(lean):
        if x > 0:
            add(source, i, x, 0.0)
        elif x < 0:
            add(i, sink, -x, 0.0)
    for i, j, c in edges:
        add(i, j, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for k in head[u]:
                if cap[k] > tiny and level[to[k]] < 0:
                    level[to[k]] = level[u] + 1
                    queue.append(to[k])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn, path, u = [0] * (n + 2), [], source
        while True:
            if u == sink:
                push = min(cap[k] for k in path)
                for k in path:
                    cap[k] -= push
                    cap[k ^ 1] += push
                cut = next(i for i, k in enumerate(path) if cap[k] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(head[u]):
                k = head[u][turn[u]]
                if cap[k] > tiny and level[to[k]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(head[u]):
                path.append(head[u][turn[u]])
                u = to[path[-1]]
            elif path:
                k = path.pop()
                u = to[k ^ 1]
                turn[u] += 1
            else:
                break


def main_text(html):
    """The page's main text: content blocks in page order, joined by one line feed; empty if there is none."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_BLOCK / (1 + _tree_distance(blocks[i - 1].at, block.at) / 2)))
        parent = block.at.parent or block.at
        if id(parent) in last and last[id(parent)] < i - 1:
            edges.append((last[id(parent)], i, SAME_PARENT))
        last[id(parent)] = i
    kept = minimum_cut([leaning(b) for b in blocks], edges)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract_pages(df, html="html"):
    """``df`` without ``html`` and with ``text`` (main text) and ``n_chars`` (its code points).

    One row per input row, in no shuffle; NULL, empty and broken HTML give what
    text there is, perhaps an empty one. Repeated rows stay. Input columns
    named ``text`` or ``n_chars`` are replaced; other columns pass unchanged.
    """
    given = [c for c in df.columns if c != html and c.lower() not in ("text", "n_chars")]
    source = df.select(*[df[f"`{c}`"] for c in given], df[f"`{html}`"])
    schema = T.StructType([source.schema[c] for c in given] + [
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())
    ])

    def extracted(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [main_text(x) for x in part.column(len(given)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(given))]
                    + [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=[*given, "text", "n_chars"],
                )

    return map_batches(source, extracted, schema)
