"""Tag-path ratios of one page: parse, aggregate per path, smooth, fuse, threshold, and align with markdown lines.

Pure Python over one page at a time; `mainbody` runs it in Arrow batches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from html import unescape
from typing import NamedTuple

#: Fixed values of HTML: elements without end tag, elements that lie within a line of text, elements of a block's structure.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small strong sub sup time u var".split())
STRUCTURE = frozenset("h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote figure figcaption".split())
CHROME = frozenset("nav header footer aside form button select label dialog".split())
#: An open element of the key ends when an element of the value begins.
ENDS_P = frozenset("p div ul ol li table h1 h2 h3 h4 h5 h6 pre form section article aside footer header nav main blockquote dl".split())

HIDDEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|head)\b.*?(?:</\1\s*>|$)", re.S | re.I)
TAG = re.compile(r"(/?)([a-zA-Z][\w:-]*)([^<>]*)")
MARKER = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NOT_WORD = re.compile(r"[\W_]+")
ASCII_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum())
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；！？]")
LINK_TARGET = re.compile(r"\]\([^()\s]*\)")
LINK = re.compile(r"!?\[([^\]]*)\]\([^()\s]*\)")

ENOUGH = 400  # characters of selected text from which the selection outweighs the heading's place
BESIDE = 0.5  # of the container's selected text, from which text of another element is the page's own too
LONG = 200  # characters of the longest paragraph of a page rich in text


class Path:
    """One root-to-leaf path of a page, with what its nodes sum up to."""

    __slots__ = ("marks", "names", "chrome", "parent", "count", "chars", "punct", "linked", "ratio", "log")

    def __init__(self, marks: tuple[str, ...], names: tuple[str, ...]):
        self.marks, self.names = marks, names
        self.chrome = not CHROME.isdisjoint(names)
        k = len(names)
        while k and (names[k - 1] in STRUCTURE or names[k - 1] == "p"):
            if names[k - 1] in ("td", "th") and "table" not in names[: k - 1]:
                break  # a stray cell serves as the page's column
            k -= 1
        self.parent = marks[:k] if k < len(names) else marks[:-1]
        self.count = self.chars = self.punct = self.linked = 0
        self.ratio = self.log = 0.0


class Node(NamedTuple):
    path: Path  # of the block, root first; each element with its class, id or role
    text: str
    linked: int  # characters inside links


class Line(NamedTuple):
    no: int
    text: str
    content: int  # 1 by structure, 0 not, -1 unknown (shape 3: the page has html all the same)
    sure: int  # 1 where the page has enough running text for its structure to be trusted
    shape: int  # 1: structure inside the container (heading, list, table, pre), 2: a plain paragraph there, 3: a block of another kind there, 0: outside


def text_nodes(html: str) -> list[Node]:
    """Blocks of text in document order, each with its root-to-leaf path; paths carry their sums and fused ratio."""
    html = HIDDEN.sub(" ", html)
    stack: list[str] = []  # open elements, and beside each its mark
    marks: list[str] = []
    nodes: list[Node] = []
    buffer: list[str] = []
    paths: dict[tuple[str, ...], Path] = {}
    path: Path | None = None  # of the open elements, once asked for
    linked = 0
    in_link = False

    at, *parts = html.split("<")
    if at:
        buffer.append(at)
    for part in parts:
        inside, end, text = part.partition(">")
        if end and inside[:2] == "a ":
            kind, closing, tag = 3, False, "a"
        elif end:
            kind, closing, tag, mark = _TAGS[inside]
        if not end or kind < 0:  # no tag: the sign is text
            buffer.append("<" + part)
            if in_link:
                linked += 1 + len(part)
            continue
        if kind:
            if kind == 3:
                in_link = not closing
            if kind > 1:
                buffer.append(" ")
            if text:
                buffer.append(text)
                if in_link:
                    linked += len(text)
            continue
        if buffer:
            words = buffer[0] if len(buffer) == 1 else "".join(buffer)
            if not words.isspace():
                path = path or _path(paths, stack, marks)
                _keep(nodes, path, words, linked)
            linked = 0
        buffer = [text] if text else []
        in_link = False
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] == tag:
                    del stack[i:], marks[i:]
                    path = None
                    break
            continue
        if stack:
            top = stack[-1]
            if top == "p" and tag in ENDS_P or tag == "li" and top == "li":
                del stack[-1], marks[-1]
                path = None
            elif tag in ("td", "th", "tr") and top in ("td", "th", "tr") and "table" in stack:
                while stack and stack[-1] in (("td", "th") if tag != "tr" else ("td", "th", "tr")):
                    del stack[-1], marks[-1]
                path = None
        if mark is not None:
            stack.append(tag)
            marks.append(mark)
            path = None
    if buffer:
        _keep(nodes, path or _path(paths, stack, marks), "".join(buffer), linked)
    for p in paths.values():
        if p.count:
            p.ratio = (p.chars / p.count) * (1 + p.punct / p.count) * (1 - p.linked / max(1, p.chars))
            p.log = math.log1p(p.ratio)
    return nodes


class _Marks(dict):
    """What class, id and role of an element's attributes say, remembered: the same attributes come back on all pages."""

    def __missing__(self, attributes: str) -> str:
        if len(self) > 50_000:
            self.clear()
        mark = ""
        for kind, x, y, z in MARKER.findall(attributes):
            value = " ".join(sorted((x or y or z).split()))
            if value:
                mark += {"class": ".", "id": "#", "role": "@"}[kind.lower()] + value
        self[attributes] = mark
        return mark


_MARKS = _Marks()


class _Tags(dict):
    """What stands between < and >, remembered: its kind, whether it closes, its name in lower case, and its mark (None if empty).

    Kinds are -1 for no tag, 0 for a block, 1 within a line, 2 without end tag, 3 for a link.
    """

    def __missing__(self, inside: str) -> tuple[int, bool, str, str | None]:
        if len(self) > 50_000:
            self.clear()
        m = TAG.fullmatch(inside)
        if m is None:
            value = (-1, False, "", None)
        else:
            tag, attributes = m[2].lower(), m[3]
            kind = 3 if tag == "a" else 1 if tag in INLINE else 2 if tag in VOID else 0
            mark = None if attributes.endswith("/") else tag + _MARKS[attributes] if "=" in attributes else tag
            value = (kind, bool(m[1]), tag, mark)
        self[inside] = value
        return value


_TAGS = _Tags()


def _path(paths: dict, stack: list[str], marks: list[str]) -> Path:
    key = tuple(marks)
    path = paths.get(key)
    if path is None:
        path = paths[key] = Path(key, tuple(stack))
    return path


def _keep(nodes: list[Node], path: Path, text: str, linked: int) -> None:
    if "&" in text:
        text = unescape(text)
    text = " ".join(text.split())
    if not text:
        return
    n = len(text)
    if linked > n:
        linked = n
    path.count += 1
    path.chars += n
    if not text.isalnum():
        path.punct += len(PUNCTUATION.findall(text))
    path.linked += linked
    nodes.append(Node(path, text, linked))


def containers_of(nodes: list[Node]) -> tuple[list[tuple[str, ...]], bool, bool]:
    """The elements whose blocks hold the page's own text, whether there is enough of it to be sure, and whether they are a guess.

    Fused path ratios are smoothed along the nodes; nodes half a deviation above the mean of the series are selected.
    The parent element with most selected text is a container, and so is every other whose text above the mean passes the
    threshold of enough text and BESIDE of the first one's; the first heading's parent stands in on pages with little text.
    """
    raw = [n.path.log for n in nodes]
    n = len(raw)
    fused = [math.sqrt(x * (0.25 * before + 0.5 * x + 0.25 * after)) for before, x, after in zip([raw[0], *raw], raw, [*raw[1:], raw[-1]])]
    mean = sum(fused) / n
    cut = mean + 0.5 * math.sqrt(sum((x - mean) ** 2 for x in fused) / n)
    weight: dict[tuple[str, ...], int] = {}
    beside: dict[tuple[str, ...], int] = {}
    heading: tuple[str, ...] | None = None
    for node, value in zip(nodes, fused):
        path = node.path
        if path.chrome:
            continue
        if heading is None and path.names and path.names[-1] == "h1":
            heading = path.parent
        if value > cut:
            weight[path.parent] = weight.get(path.parent, 0) + len(node.text) - node.linked
        if value > mean:
            beside[path.parent] = beside.get(path.parent, 0) + len(node.text) - node.linked
    best = max(weight, key=lambda p: weight[p], default=None)
    if heading is not None and (best is None or weight[best] < ENOUGH or weight.get(heading, 0) * 2 >= weight[best]):
        best = heading
    if best is None:
        best = max(nodes, key=lambda x: len(x.text)).path.parent
    held = weight.get(best, 0)
    sure = held >= ENOUGH
    apart = lambda p: p[: len(best)] != best and best[: len(p)] != p
    others = [p for p, w in beside.items() if w >= max(ENOUGH, BESIDE * held) and apart(p)] if sure else []
    return [best, *others], sure, heading is None and not sure


def node_labels(nodes: list[Node]) -> tuple[list[int], list[int], bool]:
    """Per node: content or not by structure, its shape (see Line), and whether the page is rich in text."""
    where, sure, guess = containers_of(nodes)
    state: dict[int, int] = {}  # of a path: 0 outside, 1 structure inside, 2 other inside
    depths: dict[int, int] = {}
    kinds: dict[tuple[str, ...], float] = {}
    longest = 0
    for n in nodes:
        p = n.path
        k = state.get(id(p))
        if k is None:
            k = 0
            depth = next((len(w) for w in where if p.marks[: len(w)] == w), None)
            if depth is not None:
                names = p.names[depth:]
                if CHROME.isdisjoint(names):
                    k = 1 if names and names[0] in STRUCTURE else 2
            state[id(p)] = k
            if k == 2:
                depths[id(p)] = depth
                rest = p.marks[depth:]
                kinds[rest] = kinds.get(rest, 0.0) + p.chars * p.log
        if k == 2:
            longest = max(longest, len(n.text))
    main = max(kinds, key=lambda k: kinds[k], default=None)
    final = {}
    for n in nodes:
        p = n.path
        if id(p) not in final:
            k = state[id(p)]
            if k == 2:
                rest = p.marks[depths[id(p)] :]
                if rest != main and rest != p.names[depths[id(p)] :]:
                    k = 3
            final[id(p)] = k
    shapes = [final[id(n.path)] for n in nodes]
    if guess:  # neither a heading nor enough text: only the words of a line can tell
        return [-1] * len(nodes), [3] * len(nodes), False
    return [int(k in (1, 2)) for k in shapes], shapes, sure and longest >= LONG


def page_lines(html: str | None, markdown: str) -> list[Line]:
    """The non-blank lines of markdown with what the page's structure says of each."""
    sure, no, text, content, shape = lines_of(html, markdown)
    return [Line(i, s, c, int(sure), k) for i, s, c, k in zip(no, text, content, shape)]


def lines_of(html: str | None, markdown: str) -> tuple[bool, list[int], list[str], list[int], list[int]]:
    """page_lines as a page's `sure` and the no, text, content and shape of its lines."""
    no: list[int] = []
    text: list[str] = []
    for i, s in enumerate(markdown.split("\n"), 1):
        if s and not s.isspace():
            no.append(i)
            text.append(s)
    nodes = text_nodes(html) if html else []
    if not nodes:
        return False, no, text, [-1] * len(no), [0] * len(no)
    labels, shapes, sure = node_labels(nodes)
    exact: dict[str, list[int]] = {}
    for j, n in enumerate(nodes):
        exact.setdefault(n.text.casefold(), []).append(j)
    search: _Search | None = None
    found: list[int] = []
    last = 0
    missing = False
    for s in text:
        key = " ".join(s.split()).casefold()
        at = exact.get(key)
        if at is None:
            if "](" in key:
                key = LINK.sub(r"\1", key)
            bare = key.lstrip("#*-•> ")
            at = exact.get(bare.lstrip("0123456789").lstrip(".) ")) or exact.get(bare)
            if at is None and "|" in key:
                at = exact.get(key.strip("| ").split("|")[0].strip())
        if at is None:
            search = search or _Search(nodes)
            hit = search(s, last)
            missing |= hit < 0
        elif len(at) == 1:
            hit = at[0]
        else:
            hit = next((j for j in at if j >= last), at[0])
        if hit > last:
            last = hit
        found.append(hit)
    if missing:  # a line that stands in no node goes with its block; blocks are what blank lines part
        near = found.copy()
        k = 0
        while k < len(no):
            e = k + 1
            while e < len(no) and no[e] == no[e - 1] + 1:
                e += 1
            for j in range(k, e):
                if found[j] < 0:
                    near[j] = next((found[m] for m in sorted(range(k, e), key=lambda m: abs(m - j)) if found[m] >= 0), -1)
            k = e
        found = near
    return sure, no, text, [labels[h] if h >= 0 else -1 for h in found], [shapes[h] if h >= 0 else 0 for h in found]


def letters_of(text: str) -> str:
    """The letters and digits alone, in their order."""
    text = text.encode("utf-8", "surrogatepass").translate(None, ASCII_SIGNS).decode("utf-8", "surrogatepass")
    return text if text.isalnum() else NOT_WORD.sub("", text)


class _Search:
    """Finds a line by its letters and digits alone, else by all its signs."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self.words = [letters_of(n.text).casefold() for n in nodes]
        self.joined = "".join(self.words)
        self.starts = []
        at = 0
        for w in self.words:
            self.starts.append(at)
            at += len(w)
        self.dense: list[str] | None = None

    def __call__(self, line: str, last: int) -> int:
        own = letters_of(LINK_TARGET.sub("]", line) if "](" in line else line).casefold()
        if own:
            k = self.joined.find(own, self.starts[last])
            if k < 0:
                k = self.joined.find(own)
            if k < 0:
                return -1
            hit = bisect_right(self.starts, k + len(own) // 2) - 1
            while hit > 0 and not self.words[hit]:
                hit -= 1
            return hit
        flat = SPACE.sub("", line).replace("\\", "")
        if len(flat) <= 4:
            return -1
        if self.dense is None:
            self.dense = [SPACE.sub("", n.text).replace("\\", "") for n in self.nodes]
        return next((j for j, d in enumerate(self.dense) if flat in d), -1)
