"""Main text of web pages by union-free regular-expression wrappers.

The pages of a host are aligned one after another to a wrapper. A page is a stream of tags and texts, kept as a tree;
siblings that follow each other alike become a repeated group, of one tag or of a short sequence of tags, and when a
page is aligned with the wrapper, what matches is merged, what one side lacks becomes optional, and texts that differ
become a slot while equal ones stay template text.

Pages of one structure are merged first, in any order, as that only adds counts and compares texts. Structures are then
merged in the order of their digests, in groups that their digests name, so the wrapper of a host doesn't depend on how
pages are dealt to tasks, and a host with a third of the pages is no large group. Nodes that few pages have are folded
into their parents, so a wrapper stays small however many pages there are.

The wrapper says which parts of a page are content: article elements, or main ones, or those named as content, in so
far as they hold a share of the text that differs between pages; else the smallest part that holds most of it. All
such parts of a page are taken, in page order. Left out of them are elements that by tag or name are menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or comments; and outside article and main elements also
the template text and the menus of links that the wrapper found. A page without the wrapper's parts is its own wrapper.

Of several article parts, those that stand once a page and hold the most differing text are the content; cards that repeat are it
only where no article stands alone. Within article and main elements a name must be wholly one of a menu, an advert and
so on for its element to be left out, as words like header or reply are said of parts of an article too.

Nulls: a null html is empty, its text is empty; a null url has the host ''. A host with one page has a wrapper of that
page. Repeated pages each get their text, and count as one when template text is told from content. Ties: of parts with
equal text the deepest, then the least path. Very long pages and any nesting are read whole, pages and wrappers alike, and
pages are parsed in linear time, however broken. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html as _html
import json
import re
import sys
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr del".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SELF_CLOSING = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",),
    "th": ("tr",), "option": ("select",),
}
#: Elements that are never main text, and words of class, id or role that say the same.
SKIP = frozenset("head nav header footer aside form script style noscript template iframe object embed svg canvas audio video button select option textarea input dialog menu title noembed noframes".split())
SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside header masthead footer comment comments commentlist disqus respond reply replies subscribe newsletter signup pagination pager contentinfo complementary hidden".split()
)
#: Of these, the words that hold for an element within a sentence too; and words of parts that are left out only if they are mostly links.
INLINE_WORDS = frozenset("ad ads advert advertisement sponsored hidden".split())
WEAK_WORDS = frozenset("alert share sharing social related recommended login search widget toc".split())
MAIN_WORDS = frozenset("article main content post entry story".split())
#: Words that parts of an article have in their names too; words that add nothing to a name; and whole names of articles that aren't content.
UNSURE_WORDS = frozenset("header masthead reply replies respond promotion banner notice overlay complementary hidden".split())
FILL_WORDS = frozenset("box block wrapper wrap container list section area unit slot inner outer form link links item items left right top bottom bar".split())
OTHER_ARTICLES = frozenset("comment comments commentlist ad ads advert advertisement sponsored promo".split())
#: Template text stands, equal, on so many different pages and on such a share of the host's; wrappers are folded where
#: fewer pages than this share have a node; groups in which structures are merged.
TEMPLATE_PAGES, TEMPLATE_SHARE, RARE, SALTS = 3, 0.2, 0.005, (1024, 32)
#: Of article parts, those with less than this share of the largest one's differing text aren't content.
LESSER = 0.3
#: Elements that are lines of a part, never the part.
LINES = INLINE | frozenset("p pre li dt dd h1 h2 h3 h4 h5 h6 blockquote figcaption caption td th tr".split())
#: The least share of the differing text that makes parts of a kind the content.
KINDS = (("article", 0.1), ("main", 0.2), ("named", 0.5))

NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: The rest of a tag: up to the first > that isn't in quotes; nothing is tried twice.
REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def told(names: list[str], sure: bool) -> bool:
    """Do names say that an element is no main text? Where they must be sure, a whole name has to."""
    if not sure:
        return any(w in SKIP_WORDS for n in names for w in map(str.lower, PARTS.findall(n)))
    for n in names:
        words = [w.lower() for w in PARTS.findall(n)]
        if any(w in SKIP_WORDS for w in words) and all(w in SKIP_WORDS or w in FILL_WORDS or w.isdigit() for w in words) and any(w in SKIP_WORDS and w not in UNSURE_WORDS for w in words):
            return True
    return False


@functools.lru_cache(1 << 14)  # a site's pages say the same of most elements
def described(tag: str, attrs: str, inside: bool) -> tuple[tuple[str, ...], bool, bool]:
    """The words of an element's names, whether it is never main text, and whether it isn't if it is mostly links."""
    names, skip, weak = (), tag in SKIP, False
    if attrs and ("=" in attrs or "hidden" in attrs):
        whole = [w for f in NAMES.findall(attrs) for w in (f[1] or f[2] or f[3]).split()]
        names = tuple(sorted({w.lower() for n in whole for w in PARTS.findall(n)}))
        if tag == "article":
            skip = not OTHER_ARTICLES.isdisjoint(n.lower() for n in whole)
        elif tag not in ("html", "body", "main"):
            skipped = not INLINE_WORDS.isdisjoint(names) if tag in INLINE else told(whole, inside)
            skip |= skipped or bool(HIDDEN.search(attrs))
            weak = tag not in INLINE and not WEAK_WORDS.isdisjoint(names)
    return names, skip, weak


class Element:
    __slots__ = ("tag", "names", "kids", "skip", "weak", "inside")

    def __init__(self, tag: str, attrs: str = "", parent: Element | None = None):
        self.tag, self.kids = tag, []
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))  # of an article or main element
        self.names, self.skip, self.weak = described(tag, attrs, self.inside)

    @property
    def kind(self) -> str | None:
        """What the tag or the names say of content."""
        if self.tag in ("article", "main"):
            return self.tag
        if self.tag not in ("html", "body") and "main" in self.names and len(self.names) == 1:
            return "main"
        return "named" if self.tag in ("div", "section", "td") and not MAIN_WORDS.isdisjoint(self.names) else None

    @property
    def label(self) -> str:
        """What elements match by: tag and names, but for the elements whose names often tell of the page and not of the part."""
        return self.tag if self.tag in ("html", "body", "article", "main") else self.tag + "".join(f".{n}" for n in self.names if not n.isdigit())


class Open:
    """The open elements, with the places of each tag and of all blocks, so that none is looked for along the nesting."""

    def __init__(self, root: Element):
        self.stack, self.at, self.blocks = [root], {"#root": [0]}, [0]

    def push(self, e: Element) -> None:
        self.at.setdefault(e.tag, []).append(len(self.stack))
        if e.tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(e)

    def last(self, *tags: str) -> int:
        """Where the innermost of these tags is open; 0: nowhere."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, i: int) -> None:
        """Close the element at i and all within."""
        while len(self.stack) > i:
            e = self.stack.pop()
            self.at[e.tag].pop()
            if e.tag not in INLINE:
                self.blocks.pop()


def parse(source: str) -> Element:
    """A tree of elements and texts. Missing and stray end tags are resolved as browsers do for paragraphs, lists and tables.
    What begins like a tag but never ends is text."""
    root = Element("#root")
    open_, at, text = Open(root), 0, 0
    end, raw_ends = source.rfind(">"), {}

    def put(upto: int) -> None:
        if text < upto:
            open_.stack[-1].kids.append(source[text:upto])

    while True:
        lt = source.find("<", at)
        if lt < 0 or lt > end and not source.startswith("<!--", lt):
            break
        at = lt + 1
        if source.startswith(("<!", "<?"), lt):
            if source.startswith("<!--", lt):
                close = source.find("-->", lt + 4)
                close = len(source) if close < 0 else close + 3
            else:
                close = source.index(">", lt) + 1
            put(lt)
            at = text = close
            continue
        m = NAME.match(source, lt)
        if not m:
            continue
        rest = REST.match(source, m.end())
        close = rest.end() if rest else source.index(">", m.end()) + 1
        put(lt)
        at = text = close
        tag, attrs = m[1].lower(), source[m.end() : close - 1]
        if source[lt + 1] == "/":
            i = open_.last(tag)
            if i and not (tag in INLINE and open_.blocks[-1] > i):  # a stray inline end tag doesn't close blocks
                open_.close(i)
            continue
        if tag in CLOSES_P:
            i = open_.last("p")
            if i and open_.blocks[-1] == i:
                open_.close(i)
        elif tag in SELF_CLOSING:
            alike = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            i = open_.last(*alike)
            if i > open_.last(*SELF_CLOSING[tag]):
                open_.close(i)
        e = Element(tag, attrs, open_.stack[-1])
        open_.stack[-1].kids.append(e)
        if tag in RAW:
            if tag not in raw_ends or raw_ends[tag] and raw_ends[tag].start() < at:  # looked for once, not at each tag
                raw_ends[tag] = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
            found = raw_ends[tag]
            if not e.skip:
                e.kids.append(source[at : found.start() if found else len(source)])
            at = text = found.end() if found else len(source)
        elif tag not in VOID and not attrs.endswith("/"):
            open_.push(e)
    put(len(source))
    return root


# ---- wrappers ----------------------------------------------------------------------------------
# A node is [label, optional, repeated, pages, slot, characters, characters in links, children, kind, digests]; slot is a
# digest of the one text seen so far, None without text, or False once texts differ; digests are the least TEMPLATE_PAGES
# of different pages that have the node.


def squeeze(s: str) -> str:
    return " ".join(_html.unescape(s).split())


def digest(s: str) -> str:
    return xxhash.xxh3_64_hexdigest(s.encode("utf-8", "surrogatepass"))


def below(e: Element, linked: bool) -> list:
    """(text, in a link) of all texts below e, in page order."""
    out, todo = [], [(k, linked) for k in reversed(e.kids)]
    while todo:
        k, linked = todo.pop()
        if isinstance(k, str):
            out.append((k, linked))
        elif not k.skip:
            todo += [(x, linked or k.tag == "a") for x in reversed(k.kids)]
    return out


def own_text(e: Element) -> str:
    return squeeze(" ".join(k for k in e.kids if isinstance(k, str)))


def node_of(root: Element, page: int = 0) -> list:
    """The node of an element and of all below it, whatever the nesting."""
    made: dict[int, list] = {}
    todo = [(root, root.tag == "a", False)]
    while todo:
        e, linked, ready = todo.pop()
        kids = [k for k in e.kids if isinstance(k, Element) and not k.skip and k.tag != "br"]
        if not ready:
            todo.append((e, linked, True))
            todo += [(k, linked or k.tag == "a", False) for k in kids]
            continue
        text = own_text(e)
        made[id(e)] = [e.label, False, False, 1, digest(text) if text else None, len(text), len(text) if linked else 0, repeats([made.pop(id(k)) for k in kids]), e.kind, [page]]
    return made[id(root)]


def packed(root: list) -> str:
    """A node and all below it as JSON without nesting: nodes in order, each with the number of its children for them."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append([*n[:7], len(n[7]), *n[8:]])
        todo += reversed(n[7])
    return json.dumps(out)


def unpacked(text: str) -> list:
    root: list = []
    todo = [(root, 1)]
    for n in json.loads(text):
        while not todo[-1][1]:
            todo.pop()
        kids, left = todo[-1]
        todo[-1] = kids, left - 1
        own: list = []
        kids.append([*n[:7], own, *n[8:]])
        todo.append((own, n[7]))
    return root[0]


def join_slot(a, b):
    return b if a is None else a if b is None or a == b else False


def merged(a: list, b: list, same_page: bool = False) -> list:
    """The node that both match. Within a page two siblings are one node seen once."""
    pages = max(a[3], b[3]) if same_page else a[3] + b[3]
    digests = sorted({*a[9], *b[9]})[:TEMPLATE_PAGES]
    return [
        a[0], a[1] or b[1], a[2] or b[2] or same_page, pages, join_slot(a[4], b[4]), a[5] + b[5], a[6] + b[6],
        aligned(a[7], b[7], same_page), a[8], digests,
    ]


def shape(root: list) -> str:
    """The structure alone."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append((n[0], n[1], n[2], len(n[7])))
        todo += reversed(n[7])
    return digest(json.dumps(out))


def repeats(kids: list) -> list:
    """Siblings with runs of a tag, or of up to four tags, folded into repeated groups."""
    for period in (1, 2, 3, 4):
        out: list = []
        i = 0
        while i < len(kids):
            labels = [k[0] for k in kids[i : i + period]]
            j = i + period
            group = kids[i:j]
            while len(labels) == period and [k[0] for k in kids[j : j + period]] == labels:
                group = [merged(x, y, True) for x, y in zip(group, kids[j : j + period], strict=True)]
                j += period
            if j > i + period:
                out += group
                i = j
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a common subsequence of two lists of labels: what both begin and end with, and between those the longest
    chain of labels that stand once on either side, and so on between its links. Space and, but for sorting, time are linear."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        there: dict = {}
        for y in range(j, m):
            there[b[y]] = -1 if b[y] in there else y
        here: dict = {}
        for x in range(i, n):
            here[a[x]] = -1 if a[x] in here else x
        pairs = sorted((x, there[w]) for w, x in here.items() if x >= 0 and there.get(w, -1) >= 0)
        if not pairs:  # no label stands once on both sides: the first that both have, from the left
            first = {}
            for y in range(m - 1, j - 1, -1):
                first[b[y]] = y
            at = next((x for x in range(i, n) if a[x] in first), None)
            if at is not None:
                out.append((at, first[a[at]]))
                todo.append((at + 1, n, first[a[at]] + 1, m))
            continue
        tails, ends, back = [], [], []  # the longest increasing chain, by patience
        for k, (_, y) in enumerate(pairs):
            at = bisect_left(tails, y)
            tails[at:at + 1], ends[at:at + 1] = [y], [k]
            back.append(ends[at - 1] if at else -1)
        chain, k = [], ends[-1]
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        chain.reverse()
        out += chain
        for (x, y), (u, v) in zip([(i - 1, j - 1), *chain], [*chain, (n, m)], strict=True):
            if x + 1 < u and y + 1 < v:
                todo.append((x + 1, u, y + 1, v))
    return sorted(out)


def aligned(a: list, b: list, same_page: bool = False) -> list:
    """Matching children are merged; what either side lacks becomes optional. Then repeats are folded anew."""
    la, lb = [x[0] for x in a], [x[0] for x in b]
    if la == lb:
        return [merged(x, y, same_page) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    alone = lambda x: [x[0], True, *x[2:]]
    for x, y in [*common(la, lb), (len(a), len(b))]:
        out += [alone(k) for k in a[i:x]] + [alone(k) for k in b[j:y]]
        if x < len(a):
            out.append(merged(a[x], b[y], same_page))
        i, j = x + 1, y + 1
    return repeats(out)


def in_order(root: list) -> tuple[list, list[int]]:
    """All nodes, parents first, and the place of each one's parent (-1 for the first)."""
    nodes, above, todo = [], [], [(root, -1)]
    while todo:
        n, up = todo.pop()
        nodes.append(n)
        above.append(up)
        todo += [(k, len(nodes) - 1) for k in reversed(n[7])]
    return nodes, above


def summed(values: list, above: list[int]) -> list:
    """Each node's value with those of all nodes below it."""
    out = list(values)
    for i in range(len(out) - 1, 0, -1):
        out[above[i]] += out[i]
    return out


def pruned(root: list, least: float) -> list:
    """Nodes on fewer pages than that are folded into their parents."""
    nodes, above = in_order(root)
    made = [[*n[:7], [], *n[8:]] for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):  # children before their parents
        up, n = made[above[i]], made[i]
        n[7].reverse()
        if n[3] < least:
            up[5], up[6] = up[5] + n[5], up[6] + n[6]
            for k in n[7]:  # also what was on more pages by repeating below it
                up[5], up[6] = up[5] + sum(x[5] for x in in_order(k)[0]), up[6] + sum(x[6] for x in in_order(k)[0])
        else:
            up[7].append(n)
    made[0][7].reverse()
    return made[0]


def step(above: str, label: str) -> str:
    """The digest of a path: of its parent's and its own label."""
    return digest(f"{above}/{label}")


def decisions(wrapper: list) -> dict:
    """What extraction needs: main, the paths of the parts that are content, `way`, those of all above them, and whether they
    are known by their tags; drop, the path and digest of each template text; menus, the paths of menus of links."""
    nodes, above = in_order(wrapper)
    least = TEMPLATE_SHARE * wrapper[3]
    block = [n[0].split(".")[0] not in INLINE for n in nodes]  # words within a sentence are never template or menu by themselves
    constant = [x and isinstance(n[4], str) and len(n[9]) >= TEMPLATE_PAGES and n[3] >= least for x, n in zip(block, nodes, strict=True)]
    chars, linked = summed([n[5] for n in nodes], above), summed([n[6] for n in nodes], above)
    path, depth, inside = [], [], []
    for n, up in zip(nodes, above, strict=True):
        path.append(step(path[up] if up >= 0 else "", n[0]))
        depth.append(depth[up] + 1 if up >= 0 else 0)
        inside.append((inside[up] | {nodes[up][8]} if nodes[up][8] not in inside[up] else inside[up]) if up >= 0 else frozenset())
    copies = sum(n[5] for n, x in zip(nodes, constant, strict=True) if x) > 0.8 * chars[0]  # pages of nearly the same text don't tell template from content
    drop = {(path[i], n[4]) for i, n in enumerate(nodes) if constant[i] and not copies}
    menus = {path[i] for i, n in enumerate(nodes) if block[i] and (n[2] or any(k[2] for k in n[7])) and chars[i] > 0 and linked[i] > 0.8 * chars[i]}
    got = summed([0.0 if constant[i] and not copies else float(n[5] - n[6]) for i, n in enumerate(nodes)], above)
    mass: dict[str, float] = {}
    for p, x in zip(path, got, strict=True):
        mass[p] = mass.get(p, 0) + x
    whole = got[0]

    def answer(main: set[str], tagged: bool) -> dict:
        way = set()
        for i, p in enumerate(path):
            up = above[i]
            while p in main and up >= 0 and path[up] not in way:
                way.add(path[up])
                up = above[up]
        return {"main": sorted(main), "way": sorted(way), "drop": sorted(drop), "menus": sorted(menus), "tagged": tagged}

    for kind, share in KINDS:
        of = [i for i, n in enumerate(nodes) if n[8] == kind and kind not in inside[i]]
        if of and sum(mass[p] for p in {path[i] for i in of}) >= share * whole:
            if kind == "article":  # what stands once a page before cards that repeat, and of those the ones with most text
                repeated = lambda i: nodes[i][2]
                alone = [i for i in of if not repeated(i) and mass[path[i]] >= share * whole]
                of = alone or of
                most = max(mass[path[i]] for i in of)
                of = [i for i in of if mass[path[i]] >= LESSER * most]
            return answer({path[i] for i in of}, kind != "named")
    # the smallest part that holds most; a repeated group's members, or what is within a paragraph, aren't a part. A heading
    # beside it belongs to it.
    parts = [i for i, n in enumerate(nodes) if not n[2] and n[0].split(".")[0] not in LINES and mass[path[i]] >= 0.7 * whole] if whole else []
    if not parts:
        return answer({path[0]}, False)
    i = min(parts, key=lambda i: (-depth[i], path[i]))
    while above[i] >= 0 and any(re.match(r"h[1-6](\.|$)", k[0]) for k in nodes[above[i]][7]):
        i = above[i]
    return answer({path[i]}, False)


# ---- extraction --------------------------------------------------------------------------------


def regions(root: Element, main: frozenset, way: frozenset) -> list[tuple[Element, str]]:
    """The outermost elements whose path is one of the wrapper's content parts, in page order."""
    out, todo = [], [(root, "")]
    while todo:
        e, above = todo.pop()
        path = step(above, e.label)
        if e.skip:
            continue
        if path in main:
            out.append((e, above))
        elif path in way:
            todo += [(k, path) for k in reversed(e.kids) if isinstance(k, Element)]
    return out


def mostly_links(e: Element) -> bool:
    texts = below(e, e.tag == "a")
    chars = sum(len(squeeze(t)) for t, _ in texts)
    return chars > 0 and 2 * sum(len(squeeze(t)) for t, x in texts if x) > chars


def blocks(e: Element, above: str, drop: frozenset, menus: frozenset) -> list[str]:
    """Texts of the blocks below e, in page order."""
    out: list[str] = []
    text: list[str] = []

    def flush() -> None:
        if line := " ".join(_html.unescape("".join(text)).split()):
            out.append(line)
        text.clear()

    todo: list = [(e, above)]
    while todo:
        k, path = todo.pop()
        if k is None:
            flush()
        elif isinstance(k, str):
            text.append(k)
        elif not k.skip:
            if k.tag in ("br", "img", "wbr"):
                text.append(" " if k.tag == "br" else "")
                continue
            if k is not e and k.weak and mostly_links(k):
                continue
            here = step(path, k.label) if drop or menus else ""
            if here in menus and mostly_links(k):
                continue
            kids = k.kids
            if drop and (here, digest(own_text(k))) in drop:
                kids = [x for x in kids if isinstance(x, Element)]
            if k.tag not in INLINE:
                flush()
                todo.append((None, ""))
            todo += [(x, here) for x in reversed(kids)]
    flush()
    return out


def extract(source: str | None, wrapper: dict) -> str:
    root = parse(source or "")
    found = regions(root, frozenset(wrapper["main"]), frozenset(wrapper["way"]))
    if not found:  # the page has none of the wrapper's parts
        wrapper = decisions(node_of(root))
        found = regions(root, frozenset(wrapper["main"]), frozenset(wrapper["way"])) or [(root, "")]
    some = not wrapper["tagged"]
    drop = frozenset(map(tuple, wrapper["drop"])) if some else frozenset()
    menus = frozenset(wrapper["menus"]) if some else frozenset()
    return "\n".join(t for e, above in found for t in blocks(e, above, drop, menus))


# ---- distributed form --------------------------------------------------------------------------


def _added(parts: list[str]) -> list:
    """One wrapper of pages that have the same structure."""
    out = unpacked(parts[0])
    for p in parts[1:]:
        out = merged(out, unpacked(p))
    return out


def deep() -> None:
    """Nodes are merged by calls as deep as their nesting; Python's frames for these aren't on the C stack."""
    sys.setrecursionlimit(1 << 24)


def _merge(t: pa.Table) -> list:
    """One wrapper of all rows: those of one structure first, then structures in the order of their digests."""
    deep()
    by: dict[int, list[str]] = {}
    for key, w in zip(t.column("key").to_pylist(), t.column("wrapper").to_pylist(), strict=True):
        by.setdefault(key, []).append(w)
    out = None
    for key in sorted(by):
        one = _added(by[key])
        out = merged(out, one) if out else one
    return pruned(out, RARE * out[3])


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper: the host's decisions as JSON. `pages` has host, html."""

    def structures(batches):
        deep()
        for batch in batches:
            found: dict[tuple, list] = {}
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = node_of(parse(source or ""), xxhash.xxh32_intdigest((source or "").encode("utf-8", "surrogatepass")))
                at = host, int(shape(page), 16) >> 1
                found[at] = merged(found[at], page) if at in found else page
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([k for _, k in found], pa.int64()), pa.array([packed(w) for w in found.values()], pa.string())],
                names=["host", "key", "wrapper"],
            )

    def merge(salt: int):
        return lambda key, t: pa.table({"host": [key[0].as_py()], "key": pa.array([key[1].as_py() % salt], pa.int64()), "wrapper": [packed(_merge(t))]})

    def last(key, t):
        return pa.table({"host": [key[0].as_py()], "wrapper": [json.dumps(decisions(_merge(t)))]})

    schema = "host string, key long, wrapper string"
    rows = pages.mapInArrow(structures, schema)
    for salt in SALTS:
        rows = rows.withColumn("salt", F.pmod("key", F.lit(salt))).groupBy("host", "salt").applyInArrow(merge(salt), schema)
    return rows.groupBy("host").applyInArrow(last, "host string, wrapper string")


def main_texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    scratch = c.Scratch(spark, "wrappers")
    host = c.ascii_lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    known = scratch.put(wrappers(rows.select("host", "html")), "hosts")

    def run(batches):
        deep()
        read = functools.lru_cache(64)(json.loads)  # a host's pages come together
        for batch in batches:
            for part in c.slices(batch, "html", 16 << 20):
                texts = [extract(h, read(w)) for h, w in zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([c.column(part, "page_id"), c.column(part, "url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.join(known, "host").select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark, c.table(spark, sf_dir, "pages"))
