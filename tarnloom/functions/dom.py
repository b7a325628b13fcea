"""A lenient document tree on the standard parser, and what pages are asked for: links, metadata, images, main part, markdown."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "noscript", "template"))
BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
CLOSES = {"p": BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}, "li": frozenset(("li",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)), "option": frozenset(("option",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd"))}
# Selectors of what is usually no main content, and what is kept all the same.
NOT_MAIN = (
    "header", "footer", "nav", "aside", ".header", ".top", ".navbar", "#header", ".footer", ".bottom", "#footer", ".sidebar", ".side", ".aside", "#sidebar", ".modal", ".popup", "#modal", ".overlay",
    ".ad", ".ads", ".advert", "#ad", ".lang-selector", ".language", "#language-selector", ".social", ".social-media", ".social-links", "#social", ".menu", ".navigation", "#nav", ".breadcrumbs", "#breadcrumbs",
    ".share", "#share", ".widget", "#widget", ".cookie", "#cookie", ".fc-decoration",
)
KEEP_ANYWAY = (
    "#main", ".swoogo-cols", ".swoogo-text", ".swoogo-table-div", ".swoogo-space", ".swoogo-alert", ".swoogo-sponsors", ".swoogo-title", ".swoogo-tabs", ".swoogo-logo", ".swoogo-image",
    ".swoogo-button", ".swoogo-agenda",
)


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Element]:
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                out.append(e)
            elif e.tag not in RAW:
                stack.extend(reversed(e.children))
        return "".join(out)

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children.remove(self)
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while self.at.parent is not None and tag in CLOSES.get(self.at.tag, ()):
            self.at = self.at.parent
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        e: Element | None = self.at
        while e is not None and e.tag != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def render(e: Element | str) -> str:
    if isinstance(e, str):
        return escape(e, quote=False)
    inner = "".join(c if isinstance(c, str) and e.tag in RAW else render(c) for c in e.children)
    if e.tag == "#root":
        return inner
    attrs = "".join(f' {k}="{escape(v)}"' for k, v in e.attrs.items())
    return f"<{e.tag}{attrs}>" if e.tag in VOID else f"<{e.tag}{attrs}>{inner}</{e.tag}>"


_SIMPLE = re.compile(r"([#.]?[\w-]+|\*|\[[\w-]+(?:[~^$*|]?=\"?[^\]\"]*\"?)?\])")


def _compound(selector: str):
    """A test for one compound selector (tag, #id, .class, [attr], [attr=value] and its variants); None if unsupported."""
    parts = _SIMPLE.findall(selector)
    if not parts or "".join(parts) != selector:
        return None
    tests = []
    for p in parts:
        if p == "*":
            continue
        if p[0] == "#":
            tests.append(lambda e, v=p[1:]: e.attrs.get("id") == v)
        elif p[0] == ".":
            tests.append(lambda e, v=p[1:]: v in e.attrs.get("class", "").split())
        elif p[0] == "[":
            m = re.fullmatch(r"\[([\w-]+)(?:([~^$*|]?)=\"?([^\]\"]*)\"?)?\]", p)
            name, kind, value = m[1], m[2], m[3]
            if value is None:
                tests.append(lambda e, n=name: n in e.attrs)
            else:
                how = {"": lambda a, v: a == v, "^": lambda a, v: a.startswith(v), "$": lambda a, v: a.endswith(v), "*": lambda a, v: v in a, "~": lambda a, v: v in a.split(), "|": lambda a, v: a == v or a.startswith(v + "-")}[kind]
                tests.append(lambda e, n=name, v=value, h=how: n in e.attrs and h(e.attrs[n], v))
        else:
            tests.append(lambda e, v=p.lower(): e.tag == v)
    return lambda e: all(t(e) for t in tests)


def select(root: Element, selector: str) -> list[Element]:
    """Elements in document order for a list of selectors of compounds joined by blanks or '>'; [] if unsupported."""
    out: list[Element] = []
    chains = []
    for one in selector.split(","):
        steps = re.findall(r"(>?)\s*([^\s>]+)", one.strip())
        tests = [(c, _compound(s)) for c, s in steps]
        if not tests or any(t is None for _, t in tests):
            return []
        chains.append(tests)

    def fits(e: Element, tests: list) -> bool:
        if not tests[-1][1](e):
            return False
        if len(tests) == 1:
            return True
        p = e.parent
        if tests[-1][0] == ">":
            return p is not None and fits(p, tests[:-1])
        while p is not None:
            if fits(p, tests[:-1]):
                return True
            p = p.parent
        return False

    for e in root.walk():
        if e.tag != "#root" and any(fits(e, t) for t in chains):
            out.append(e)
    return out


def links(html: str | None) -> list[str]:
    """All a[href] in document order, repeated ones too; http:/x repaired."""
    return [re.sub(r"^(https?):/([^/])", r"\1://\2", e.attrs["href"]) for e in parse(html).walk() if e.tag == "a" and "href" in e.attrs]


def base_href(html: str | None, url: str) -> str:
    for e in parse(html).walk():
        if e.tag == "base" and e.attrs.get("href"):
            return urljoin(url, e.attrs["href"])
    return url


def absolute_links(html: str | None, url: str) -> list[str]:
    base = base_href(html, url)
    out = []
    for h in links(html):
        h = h.strip()
        if not h or h.startswith("#"):
            continue
        out.append(h if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", h) else urljoin(base, h))
    return list(dict.fromkeys(out))


def metadata(html: str | None) -> dict[str, list[str]]:
    """title, language, favicon and every meta name, property or itemprop with its contents in order."""
    out: dict[str, list[str]] = {}
    for e in parse(html).walk():
        if e.tag == "title" and "title" not in out:
            out["title"] = [e.text().strip()]
        elif e.tag == "html" and e.attrs.get("lang"):
            out.setdefault("language", [e.attrs["lang"]])
        elif e.tag == "link" and "icon" in e.attrs.get("rel", "").split() and e.attrs.get("href"):
            out.setdefault("favicon", [e.attrs["href"]])
        elif e.tag == "meta" and "content" in e.attrs:
            name = e.attrs.get("name") or e.attrs.get("property") or e.attrs.get("itemprop")
            if name:
                out.setdefault(name, []).append(e.attrs["content"])
    if len(out.get("description", ())) > 1:
        out["description"] = [", ".join(out["description"])]
    return out


def attributes(html: str | None, selector: str, attribute: str) -> list[str]:
    """Values of an attribute, or of data-attribute where it is missing, of the selected elements."""
    found = (e.attrs.get(attribute, e.attrs.get(f"data-{attribute}")) for e in select(parse(html), selector))
    return [x for x in found if x is not None]


def _srcset(value: str) -> list[tuple[str, float]]:
    out = []
    for part in value.split(","):
        bits = part.split()
        if bits:
            size = bits[1] if len(bits) > 1 else "1x"
            out.append((bits[0], float(size[:-1]) if re.fullmatch(r"[\d.]+[wx]", size) else 1.0))
    return out


def images(html: str | None, url: str) -> list[str]:
    """Distinct absolute addresses of pictures: img, source, og and twitter cards, icons, posters and css."""
    out: list[str] = []
    root = parse(html)
    for e in root.walk():
        a = e.attrs
        if e.tag == "img":
            out += [a[k] for k in ("src", "data-src") if a.get(k)]
        if e.tag in ("img", "source") and a.get("srcset"):
            out += [u for u, _ in _srcset(a["srcset"])]
        if e.tag == "meta" and (a.get("property") or a.get("name") or "") in ("og:image", "og:image:url", "og:image:secure_url", "twitter:image", "twitter:image:src") and a.get("content"):
            out.append(a["content"])
        if e.tag == "link" and {"icon", "apple-touch-icon", "image_src"} & set(a.get("rel", "").split()) and a.get("href"):
            out.append(a["href"])
        if e.tag == "video" and a.get("poster"):
            out.append(a["poster"])
        css = a.get("style", "") + (e.text() if e.tag == "style" else "") + ("".join(c for c in e.children if isinstance(c, str)) if e.tag == "style" else "")
        out += re.findall(r"url\(\s*['\"]?([^'\")]+)['\"]?\s*\)", css)
    base = base_href(html, url)
    kept = (u if u.startswith("data:") else urljoin(base, u.strip()) for u in out if u.strip() and not u.strip().lower().startswith("javascript:"))
    return list(dict.fromkeys(kept))


def transform(html: str | None, url: str, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), only_main: bool = True) -> str:
    """The page's html for reading: chosen parts, no head and scripts, no chrome, widest pictures, absolute addresses."""
    root = parse(html)
    base = base_href(html, url)
    if include:
        chosen = [e for s in include for e in select(root, s)]
        top = Element("#root", {}, None)
        for e in chosen:
            if not any(p in chosen for p in _ancestors(e)):
                top.children.append(e)
        for e in top.children:
            e.parent = top
        root = top
    for e in list(root.walk()):
        if e.tag in ("head", "meta", "noscript", "style", "script"):
            e.remove()
    for s in exclude:
        for e in select(root, s):
            e.remove()
    if only_main:
        for s in NOT_MAIN:
            for e in select(root, s):
                if not any(select(_alone(e), k) for k in KEEP_ANYWAY):
                    e.remove()
    for e in root.walk():
        if e.tag == "img" and e.attrs.get("srcset"):
            best = max(_srcset(e.attrs["srcset"]), key=lambda x: x[1], default=None)
            if best:
                e.attrs["src"] = best[0]
        for k in ("src", "href"):
            if e.attrs.get(k) and not e.attrs[k].startswith(("#", "data:")):
                e.attrs[k] = urljoin(base, e.attrs[k])
    return render(root)


def _ancestors(e: Element) -> Iterator[Element]:
    p = e.parent
    while p is not None:
        yield p
        p = p.parent


def _alone(e: Element) -> Element:
    top = Element("#root", {}, None)
    top.children.append(e)
    return top


def markdown(html: str | None) -> str:
    """GitHub-flavoured markdown of a page's html."""
    text = _blocks(parse(html), 0)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def _inline(e: Element | str) -> str:
    if isinstance(e, str):
        return re.sub(r"\s+", " ", e)
    if e.tag in RAW or e.tag == "head":
        return ""
    if e.tag == "br":
        return "  \n"
    if e.tag == "img":
        return f"![{e.attrs.get('alt', '')}]({e.attrs.get('src', '')})"
    if e.tag == "code":
        t = e.text()
        fence = "`" * (max((len(x) for x in re.findall(r"`+", t)), default=0) + 1)
        pad = " " if t.startswith("`") or t.endswith("`") else ""
        return f"{fence}{pad}{t}{pad}{fence}"
    inner = "".join(map(_inline, e.children))
    mark = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~", "s": "~~"}.get(e.tag)
    if mark and inner.strip():
        lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        return f"{lead}{mark}{inner.strip()}{mark}{tail}"
    if e.tag == "a" and e.attrs.get("href"):
        return f"[{inner.strip()}]({e.attrs['href']})"
    return inner


def _language(e: Element) -> str:
    for x in (e, *(c for c in e.children if isinstance(c, Element))):
        for c in x.attrs.get("class", "").split():
            m = re.fullmatch(r"(?:language|lang)-(\w[\w+#-]*)", c)
            if m:
                return m[1]
    return ""


def _code(e: Element) -> str:
    if any("gutter" in c.attrs.get("class", "").split() for c in e.walk()):
        for g in [c for c in e.walk() if "gutter" in c.attrs.get("class", "").split()]:
            g.remove()
    body = e.text().strip("\n")
    fence = "`" * max(3, max((len(x) for x in re.findall(r"`+", body)), default=0) + 1)
    return f"\n\n{fence}{_language(e)}\n{body}\n{fence}\n\n"


def _table(e: Element) -> str:
    rows = [[re.sub(r"\s+", " ", _inline_all(c)).strip().replace("|", "\\|") for c in r.children if isinstance(c, Element) and c.tag in ("td", "th")] for r in e.walk() if r.tag == "tr"]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    lines = ["| " + " | ".join(r) + " |" for r in rows]
    return "\n\n" + "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]) + "\n\n"


def _inline_all(e: Element) -> str:
    return "".join(map(_inline, e.children))


def _list(e: Element, depth: int) -> str:
    out, n = [], int(e.attrs["start"]) if e.attrs.get("start", "").isdigit() else 1
    for c in e.children:
        if isinstance(c, Element) and c.tag == "li":
            mark = f"{n}. " if e.tag == "ol" else "- "
            n += 1
            body = _blocks(c, depth + 1).strip()
            pad = "\n" + " " * len(mark)
            out.append(mark + re.sub(r"\n{2,}(?=[-\d])", "\n", body).replace("\n", pad))
    return "\n\n" + "\n".join(out) + "\n\n"


def _blocks(e: Element, depth: int) -> str:
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        t = "".join(line)
        if t.strip():
            out.append(re.sub(r" *\n *", "\n", t.strip()) if "  \n" not in t else t.strip())
        line.clear()

    for c in e.children:
        if isinstance(c, str) or c.tag not in BLOCK and c.tag not in RAW and c.tag != "head":
            line.append(_inline(c))
            continue
        end()
        if c.tag in RAW or c.tag == "head":
            continue
        if re.fullmatch(r"h[1-6]", c.tag):
            t = re.sub(r"\s+", " ", _inline_all(c)).strip()
            if t:
                out.append(f"\n\n{'#' * int(c.tag[1])} {t}\n\n")
        elif c.tag == "pre":
            out.append(_code(c))
        elif c.tag == "table":
            out.append(_table(c))
        elif c.tag in ("ul", "ol"):
            out.append(_list(c, depth))
        elif c.tag == "hr":
            out.append("\n\n---\n\n")
        elif c.tag == "blockquote":
            out.append("\n\n" + "\n".join("> " + x if x else ">" for x in _blocks(c, depth).strip().split("\n")) + "\n\n")
        else:
            out.append("\n\n" + _blocks(c, depth).strip() + "\n\n")
    end()
    return "\n\n".join(x.strip("\n") for x in out if x.strip())


def tidy_markdown(text: str) -> str:
    """Line breaks inside link texts are escaped; links that only skip to the content go."""
    out, depth = [], 0
    for i, ch in enumerate(text):
        if ch == "[" and (i == 0 or text[i - 1] != "\\"):
            depth += 1
        elif ch == "]" and depth and text[i - 1] != "\\":
            depth -= 1
        out.append("\\\n" if ch == "\n" and depth else ch)
    return re.sub(r"\[skip to content\]\(#[^)]*\)", "", "".join(out), flags=re.I)
