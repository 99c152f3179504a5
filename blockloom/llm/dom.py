"""Block trees of web pages: a tolerant reader, repeated siblings folded into iterated nodes, and simple tree matching.

Only elements that lay out blocks are nodes (and inline ones that are left out by name); text belongs to the innermost
block. Unclosed and misnested tags follow the usual rules of implied ends; reading is one pass with a stack, so neither
length nor depth of a page is bounded by recursion."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import xxhash

#: Nodes below this depth hang on their ancestor at it, and longer lists of children are folded by tag alone.
DEPTH = 48
WIDE = 64
#: A block outside the article with this share of its characters in links is a menu.
LINKED = 0.8

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote button canvas caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr iframe legend li "
    "main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td template textarea tfoot th thead tr ul video audio".split()
)
_ENDS_P = BLOCK - frozenset("html body head button caption colgroup iframe noscript object option optgroup select svg canvas tbody td template textarea tfoot th thead tr video audio".split())
_IMPLIED = {  # a start tag ends an open element of these, up to one of those
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
_IN_HEAD = frozenset("base head link meta noscript script style template title".split())
_SCOPE = frozenset("table td th caption template object".split())
#: Elements that are never main text.
OUTSIDE = frozenset("aside audio button canvas dialog footer form head iframe menu nav noembed noframes noscript object script search select style svg template textarea title video".split())
_NAMES = (
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer form gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pagination "
    "paywall popup promo promotion recommended related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe teaser teasers toolbar topbar widget widgets"
)
_BEFORE = "article author bottom comment content cookie footer global header home left main mobile page post primary privacy reader readers related right secondary site sub top user web"
_LEFT_OUT = re.compile(rf"(?:(?:{'|'.join(_BEFORE.split())})[-_]?)*(?:{'|'.join(_NAMES.split())})(?:[-_].*|\d*)")
_PAGE_HEAD = re.compile(r"(?:(?:site|page|top|main|global|web)[-_]?)*header(?:[-_].*)?")
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)[^>]*+>?|<[!?/][^>]*>?", re.S)
_ATTR = re.compile(r"(class|id|role|style|hidden|itemprop|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW}


@lru_cache(4096)
def _verdict(tag: str, attrs: str) -> str:
    """What a start tag says: `out` (left out), `head` (left out except in an article), `main`, `article` or nothing."""
    got = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    names = [n.lower() for n in (got.get("class", "") + " " + got.get("id", "")).split()]
    hidden = "hidden" in got or re.search(r"display\s*:\s*none", got.get("style", ""), re.I)
    if tag in ("html", "body"):
        return ""
    if tag in OUTSIDE or hidden or got.get("role", "").lower() in _ROLES or any(_LEFT_OUT.fullmatch(n) for n in names):
        return "form" if tag == "form" else "out"
    if tag == "header" or any(_PAGE_HEAD.fullmatch(n) for n in names):
        return "head"
    if tag == "article" or got.get("itemprop", "").lower() == "articlebody":
        return "article"
    return "main" if tag == "main" or got.get("role", "").lower() == "main" else ""


class Page:
    """The blocks of a page in page order: node, text, and where they stand.

    Blocks are (node, text, area, links): area 2 in an article, 1 in a main part, 0 elsewhere, -1 left out; links is the
    number of characters in links. `skeleton` is the folded tree, a line `depth label` a node in page order; `slots` maps
    nodes to its lines."""

    def __init__(self, html: str):
        self.tags, self.parents, self.children = ["#"], [-1], [[]]
        self.areas, self.heads = [0], [False]
        self.blocks: list[tuple[int, str, int, int]] = []
        self._read(html)
        self._fold()

    def _open(self, tag: str, verdict: str, stack: list[int]) -> None:
        up = stack[min(len(stack), DEPTH) - 1]
        area = self.areas[stack[-1]]
        if verdict == "out" or verdict == "head" and area <= 0:
            area = -1
        elif verdict == "form":
            area = min(area, -2) if area != -1 else -1  # an article in a form around the whole page counts
        elif verdict == "article" and area != -1:
            area = 2
        elif verdict == "main" and area in (0, -2):
            area = 1
        node = len(self.tags)
        self.tags.append(tag + "!" * (area < 0))
        self.parents.append(up)
        self.children.append([])
        self.children[up].append(node)
        self.areas.append(area)
        stack.append(node)

    def _read(self, html: str) -> None:
        stack, names, text, links = [0], ["#"], [], 0
        anchors, at, n = 0, 0, len(html)

        def flush() -> None:
            nonlocal links
            if text:
                words = " ".join(unescape("".join(text)).split())
                if words:
                    self.blocks.append((stack[-1], words, max(self.areas[stack[-1]], -1), min(links, len(words))))
                text.clear()
            links = 0

        def say(s: str) -> None:
            nonlocal links
            text.append(s)
            if anchors:
                links += len(s)

        def close(tags, stop=frozenset()) -> None:
            for i in range(len(names) - 1, 0, -1):
                if names[i] in tags:
                    flush()
                    del names[i:], stack[i:]
                    return
                if names[i] in stop:
                    return

        while at < n:
            m = _TOKEN.search(html, at)
            if m is None:
                say(html[at:])
                break
            if m.start() > at:
                say(html[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m["data"]:
                    say(m["data"].replace("&", "&amp;"))
                continue
            tag = tag.lower()
            if m["end"]:
                if tag == "a":
                    anchors = 0
                elif tag == "br":
                    text.append(" ")
                elif tag == "p" and "p" not in names:
                    flush()
                elif tag in BLOCK or tag in names:
                    close({tag}, _SCOPE if tag not in _SCOPE else frozenset())
                continue
            attrs = m["attrs"]
            if tag in VOID:
                if tag == "br":
                    text.append(" ")
                elif tag == "hr":
                    flush()
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else n
                continue
            if tag == "a":
                anchors = 1
            if "head" in names and tag not in _IN_HEAD:  # a head ends where the body begins
                close({"head"})
            verdict = _verdict(tag, attrs)
            if tag in BLOCK:
                flush()
                if tag in _ENDS_P:
                    close({"p"}, BLOCK - {"p"})
                if tag in _IMPLIED:
                    for _ in range(3):
                        close(*_IMPLIED[tag])
                        if tag in ("li", "option", "dt", "dd"):
                            break
            elif verdict in ("", "head") and tag not in names:
                continue
            else:
                flush()
            if tag in ("html", "body") and tag in names:
                continue
            if attrs.endswith("/") and (tag not in BLOCK or tag == "svg"):
                continue
            names.append(tag)
            self._open(tag, verdict, stack)
        flush()

    def _fold(self) -> None:
        """Runs of siblings of one shape are one iterated node; lists of over WIDE runs have one node a tag."""
        shape: dict[int, int] = {}
        known: dict[tuple, int] = {}
        groups: dict[int, list[list[int]]] = {}

        def by_tag(nodes: list[int]) -> list[list[int]]:
            found: dict[str, list[int]] = {}
            for c in nodes:
                found.setdefault(self.tags[c], []).append(c)
            return list(found.values())

        for v in range(len(self.tags) - 1, -1, -1):  # children come after their parents
            runs: list[list[int]] = []
            for c in self.children[v]:
                if runs and shape[runs[-1][0]] == shape[c]:
                    runs[-1].append(c)
                else:
                    runs.append([c])
            if len(runs) > WIDE:
                runs = by_tag(self.children[v])
                key = (self.tags[v], tuple(-1 - known.setdefault((self.tags[r[0]],), len(known)) for r in runs))
            else:
                key = (self.tags[v], tuple(shape[r[0]] for r in runs))
            groups[v] = runs
            shape[v] = known.setdefault(key, len(known))
        lines: list[str] = []
        self.slots = [0] * len(self.tags)
        todo = [([0], 0)]
        while todo:
            run, depth = todo.pop()
            for v in run:
                self.slots[v] = len(lines)
            lines.append(f"{depth} {self.tags[run[0]]}")
            if len({shape[v] for v in run}) == 1:  # the same runs in each
                below = [[c for v in run for c in groups[v][i]] for i in range(len(groups[run[0]]))]
            else:  # folded by tag: so are their children
                below = by_tag([c for v in run for c in self.children[v]])
            todo += [(r, depth + 1) for r in reversed(below)]
        self.skeleton = "\n".join(lines)


def text_hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def _tree(skeleton: str) -> tuple[list[str], list[list[int]], list[int]]:
    labels, children, path, parents = [], [], [], []
    for i, line in enumerate(skeleton.split("\n")):
        depth, label = line.split(" ", 1)
        labels.append(label)
        children.append([])
        del path[int(depth) :]
        parents.append(path[-1] if path else -1)
        if path:
            children[path[-1]].append(i)
        path.append(i)
    return labels, children, parents


def match(a: str, b: str) -> dict[int, int]:
    """Simple tree matching of two skeletons: the largest order-preserving matching of nodes of equal labels whose parents
    match too, as lines of a to lines of b (of equal ones, the matching that takes the earliest children)."""
    la, ca, _ = _tree(a)
    lb, cb, _ = _tree(b)
    if la[0] != lb[0]:
        return {}
    pairs, level = [(0, 0)], [(0, 0)]
    while level:  # all pairs of one depth whose ancestors could match
        level = [(x, y) for u, v in level for x in ca[u] for y in cb[v] if la[x] == lb[y]]
        pairs += level
    weight: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], np.ndarray] = {}
    for u, v in reversed(pairs):
        xs, ys = ca[u], cb[v]
        best = np.zeros((len(xs) + 1, len(ys) + 1), np.int32)
        for i, x in enumerate(xs):
            row = best[i].copy()
            row[1:] = np.maximum(best[i, 1:], best[i, :-1] + np.array([weight.get((x, y), 0) for y in ys], np.int32)) if ys else row[1:]
            best[i + 1] = np.maximum.accumulate(row)
        weight[u, v], tables[u, v] = 1 + int(best[-1, -1]), best
    found, todo = {}, [(0, 0)]
    while todo:
        u, v = todo.pop()
        found[u] = v
        best, i, j = tables[u, v], len(ca[u]), len(cb[v])
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((ca[u][i], cb[v][j]))
    return found


def slots(skeleton: str, reference: str) -> list[int]:
    """The slot of each line: the line of the reference it matches, else (negative) a hash of its labels from the root."""
    labels, _, parents = _tree(skeleton)
    same = {i: i for i in range(len(labels))} if skeleton == reference else match(skeleton, reference)
    paths: list[str] = []
    for label, up in zip(labels, parents):
        paths.append(f"{paths[up]}/{label}" if up >= 0 else label)
    return [same[i] if i in same else -1 - (text_hash(p) & (1 << 62) - 1) for i, p in enumerate(paths)]
