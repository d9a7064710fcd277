"""Per-page HTML helper used inside Spark tasks (mapInPandas / pandas_udf).

One parse per page with the standard-library parser builds a small element tree;
selectors are a fixed subset: tag, .class, #id, tag.class, tag#id, [attr],
tag[attr], tag[attr=value], descendant chains, and XPath steps
//tag, /tag, [@attr], [@attr='v'] with a trailing /@attr or /text().
Unsupported selectors are rejected when the configuration is read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

from gazette import config as C

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def get(self, name, default=None):
        return self.attrs.get(name, default)

    def classes(self):
        return (self.attrs.get("class") or "").split()


_BREAK = object()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: ("" if v is None else v) for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_comment(self, data):
        self.cur.children.append(_BREAK)    # a comment separates the strings around it

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        kids = self.cur.children
        if kids and isinstance(kids[-1], str):   # adjacent text is one string
            kids[-1] += data
        else:
            kids.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:  # a broken page still yields what was read
        pass
    return b.root


def iter_nodes(node: Node):
    """Elements in document order."""
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))


def strings(node: Node, skip_raw: bool = True):
    stack = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            yield n
        elif isinstance(n, Node) and not (skip_raw and n.tag in RAW_TEXT):
            stack.extend(reversed(n.children))


def get_text(node: Node, sep: str = "", strip: bool = True, skip_raw: bool = True) -> str:
    """Text of an element: each string stripped (Python str.strip), empty ones dropped,
    joined by sep. Script and style contents are not text."""
    parts = (s.strip() for s in strings(node, skip_raw)) if strip else strings(node, skip_raw)
    return sep.join(p for p in parts if p)


def text_content(node: Node) -> str:
    """XPath-style text: every descendant string concatenated."""
    return "".join(strings(node, skip_raw=False))


# --------------------------------------------------------------------------- CSS subset
_COMPOUND = re.compile(r"^(?P<tag>[A-Za-z][\w-]*|\*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)$")
_PART = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*['\"]?([^'\"\]]*)['\"]?)?\s*\]")


def parse_css(selector: str):
    chain = []
    for comp in selector.split():
        m = _COMPOUND.match(comp)
        if not m or comp in ("", ">", "+", "~"):
            raise ValueError(f"unsupported selector: {selector!r}")
        tag = (m.group("tag") or "*").lower()
        classes, ids, attrs = [], [], []
        for p in _PART.finditer(m.group("rest")):
            if p.group(1) == ".":
                classes.append(p.group(2))
            elif p.group(1) == "#":
                ids.append(p.group(2))
            else:
                attrs.append((p.group(3).lower(), p.group(4)))
        chain.append((tag, tuple(classes), tuple(ids), tuple(attrs)))
    if not chain:
        raise ValueError(f"empty selector: {selector!r}")
    return tuple(chain)


def _match(node: Node, comp) -> bool:
    tag, classes, ids, attrs = comp
    if tag != "*" and node.tag != tag:
        return False
    if classes and not set(classes) <= set(node.classes()):
        return False
    if ids and any(node.get("id") != i for i in ids):
        return False
    for name, value in attrs:
        if name not in node.attrs or (value is not None and node.attrs[name] != value):
            return False
    return True


def _matches_chain(node: Node, chain) -> bool:
    if not _match(node, chain[-1]):
        return False
    i, anc = len(chain) - 2, node.parent
    while i >= 0 and anc is not None:
        if _match(anc, chain[i]):
            i -= 1
        anc = anc.parent
    return i < 0


def select(root: Node, chain):
    return [n for n in iter_nodes(root) if n.parent is not None and _matches_chain(n, chain)]


def select_one(root: Node, chain):
    for n in iter_nodes(root):
        if n.parent is not None and _matches_chain(n, chain):
            return n
    return None


# --------------------------------------------------------------------------- XPath subset
_STEP = re.compile(r"(//|/)([A-Za-z*][\w-]*|@[\w-]+|text\(\))((?:\[[^\]]*\])*)")
_PRED = re.compile(r"\[\s*@([\w-]+)\s*(?:=\s*['\"]([^'\"]*)['\"])?\s*\]")


def parse_xpath(expr: str):
    steps, pos = [], 0
    for m in _STEP.finditer(expr):
        if m.start() != pos:
            raise ValueError(f"unsupported xpath: {expr!r}")
        preds = tuple((p.group(1), p.group(2)) for p in _PRED.finditer(m.group(3)))
        if len("".join(p.group(0) for p in _PRED.finditer(m.group(3)))) != len(m.group(3)):
            raise ValueError(f"unsupported xpath predicate: {expr!r}")
        steps.append((m.group(1), m.group(2), preds))
        pos = m.end()
    if pos != len(expr) or not steps:
        raise ValueError(f"unsupported xpath: {expr!r}")
    return tuple(steps)


def xpath(root: Node, steps):
    """Nodes, or strings for a final /@attr or /text() step."""
    current = [root]
    for axis, name, preds in steps:
        if name.startswith("@") or name == "text()":
            out = []
            for n in current:
                if name == "text()":
                    out.extend(c for c in n.children if isinstance(c, str))
                elif name[1:] in n.attrs:
                    out.append(n.attrs[name[1:]])
            return out
        nxt, seen = [], set()
        for n in current:
            cands = (c for c in iter_nodes(n) if c is not n) if axis == "//" else \
                    (c for c in n.children if isinstance(c, Node))
            for c in cands:
                if (name == "*" or c.tag == name.lower()) and all(
                        k in c.attrs and (v is None or c.attrs[k] == v) for k, v in preds):
                    if id(c) not in seen:
                        seen.add(id(c))
                        nxt.append(c)
        current = nxt
    return current


class Selector:
    """A compiled field selector: '//' starts XPath, anything else is CSS."""

    def __init__(self, text: str):
        self.text = text
        self.is_xpath = text.startswith("//")
        self.compiled = parse_xpath(text) if self.is_xpath else parse_css(text)

    def first_text(self, root: Node) -> str | None:
        """F2 (CSS: strings stripped, joined with no separator) / F3 (XPath: string
        result or element text, outer strip only)."""
        if self.is_xpath:
            res = xpath(root, self.compiled)
            if not res:
                return None
            return res[0].strip() if isinstance(res[0], str) else text_content(res[0]).strip()
        n = select_one(root, self.compiled)
        return None if n is None else get_text(n, "", True)

    def first_node(self, root: Node):
        if self.is_xpath:
            res = xpath(root, self.compiled)
            return res[0] if res and not isinstance(res[0], str) else None
        return select_one(root, self.compiled)

    def nodes(self, root: Node):
        if self.is_xpath:
            return [r for r in xpath(root, self.compiled) if not isinstance(r, str)]
        return select(root, self.compiled)


def validate_selectors(selectors: dict) -> dict:
    """Reject unsupported selectors once, when the configuration is read."""
    return {k: Selector(v) for k, v in (selectors or {}).items() if v}


# --------------------------------------------------------------------------- page work
_MAIN = tuple(parse_css(s) for s in C.MAIN_CONTENT_CHAIN)


def main_content(root: Node) -> str | None:
    """First match of the main-content chain joined by ' ', else the body text cut
    to 5000 characters (the cut applies to the body fall-back only)."""
    for chain in _MAIN:
        n = select_one(root, chain)
        if n is not None:
            return get_text(n, " ", True)
    body = select_one(root, (("body", (), (), ()),))
    if body is not None:
        return get_text(body, " ", True)[:C.BODY_FALLBACK_CHARS]
    return None


def strip_markup(fragment: str | None) -> str | None:
    """text of an HTML fragment, strings stripped and joined by ' '."""
    if fragment is None:
        return None
    return get_text(parse(fragment), " ", True)


def link_hrefs(root: Node, selector: str | None) -> list:
    """Href of each selected element; an element without its own href uses its first
    descendant a[href] (L6). No dedup of links."""
    sel = Selector(selector) if selector else Selector("a[href]")
    out = []
    if sel.is_xpath:
        res = xpath(root, sel.compiled)
        for r in res:
            href = r if isinstance(r, str) else r.get("href")
            if href:
                out.append(href)
        return out
    for n in sel.nodes(root):
        href = n.get("href")
        if not href:
            inner = select_one(n, (("a", (), (), (("href", None),)),))
            href = inner.get("href") if inner is not None else None
        if href:
            out.append(href)
    return out


def resolve(base: str | None, href: str | None) -> str | None:
    """RFC 3986 reference resolution (urllib.parse.urljoin)."""
    if href is None:
        return None
    return urljoin(base or "", href)
