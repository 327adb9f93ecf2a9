"""A small document tree with text and tails, a lenient builder, and the XPath that rules use."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("tag", "attrs", "text", "tail", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.text = self.tail = ""
        self.children: list[Node] = []

    def walk(self) -> Iterator[Node]:
        """Itself and all below, in document order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.children))

    def texts(self) -> Iterator[str]:
        """Text and tails inside, in document order; its own tail isn't inside."""
        todo: list[Node | str] = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
                continue
            if x.text:
                yield x.text
            for c in reversed(x.children):
                if c.tail:
                    todo.append(c.tail)
                todo.append(c)

    def content(self) -> str:
        return "".join(self.texts())

    def index(self) -> int:
        return next(i for i, c in enumerate(self.parent.children) if c is self)

    def following(self) -> Node | None:
        after = self.parent.children[self.index() + 1 :] if self.parent else []
        return after[0] if after else None

    def detach(self) -> None:
        """Out of the tree, the tail with it."""
        if self.parent is not None:
            del self.parent.children[self.index()]
            self.parent = None

    def detach_keeping_tail(self) -> None:
        """Out of the tree; the tail goes to what stood before."""
        if self.parent is None:
            return
        at = self.index()
        if self.tail:
            if at:
                self.parent.children[at - 1].tail += self.tail
            else:
                self.parent.text += self.tail
            self.tail = ""
        self.detach()

    def place_after(self, other: Node) -> None:
        self.parent = other.parent
        other.parent.children.insert(other.index() + 1, self)


class _Builder(HTMLParser):
    """Unmatched end tags are passed over; what is open at an end tag that matches further out ends with it."""

    def __init__(self, html: bool):
        super().__init__(convert_charrefs=False)
        self.root = Node("root")
        self.now, self.html = self.root, html

    def _write(self, text: str) -> None:
        if self.now.children:
            self.now.children[-1].tail += text
        else:
            self.now.text += text

    def handle_starttag(self, tag, attrs):
        if self.html:
            ended = _CLOSED_BY.get(tag, set()) | ({"p"} if tag in _ENDS_P else set())
            while self.now.tag in ended:
                self.now = self.now.parent
        node = Node(bare(tag), {bare(k): v if v is not None else "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if not (self.html and tag in VOID):
            self.now = node

    def handle_startendtag(self, tag, attrs):
        before = self.now
        self.handle_starttag(tag, attrs)
        self.now = before if self.now.parent is before else self.now

    def handle_endtag(self, tag):
        tag, node = bare(tag), self.now
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.now = node.parent

    def handle_data(self, data):
        self._write(data)

    def handle_entityref(self, name):
        self._write(f"&{name}")

    def handle_charref(self, name):
        self._write(f"&#{name}")


def bare(name: str) -> str:
    """Without a namespace prefix."""
    return name.split(":", 1)[1] if ":" in name[1:] else name


def parse(markup: str, html: bool = False) -> Node:
    """A tree under a node named root; html: p, li and the like end by themselves, and some tags are empty."""
    builder = _Builder(html)
    builder.feed(markup)
    builder.close()
    return builder.root


_STEP = re.compile(r"(//|/)?([\w*-]+)(?:\[((?:[^\[\]\"']|\"[^\"]*\"|'[^']*')*)\])?")
_TOKEN = re.compile(r"\s*(not\(|contains\(\s*(?:\.|@[\w:-]+)\s*,\s*(?:\"[^\"]*\"|'[^']*')\s*\)|local-name\(\)|@[\w:-]+|\"[^\"]*\"|'[^']*'|=|\(|\)|and\b|or\b)")


def _condition(source: str) -> Callable[[Node], bool]:
    """A test of ``@a="v"``, ``local-name()="v"``, ``contains(., "v")``, joined by and, or, not( )."""
    tokens = _TOKEN.findall(source)
    at = 0

    def peek() -> str:
        return tokens[at] if at < len(tokens) else ""

    def take() -> str:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def either():
        left = both()
        while peek() == "or":
            take()
            a, b = left, both()
            left = lambda n, a=a, b=b: a(n) or b(n)
        return left

    def both():
        left = one()
        while peek() == "and":
            take()
            a, b = left, one()
            left = lambda n, a=a, b=b: a(n) and b(n)
        return left

    def one():
        t = take()
        if t == "not(":
            inner = either()
            take()
            return lambda n: not inner(n)
        if t == "(":
            inner = either()
            take()
            return inner
        if t.startswith("contains("):
            what, text = re.fullmatch(r"contains\(\s*(\.|@[\w:-]+)\s*,\s*[\"'](.*)[\"']\s*\)", t, re.S).groups()
            if what == ".":
                return lambda n: text in n.content()
            return lambda n: text in n.attrs.get(bare(what[1:]), "")
        value = None
        if peek() == "=":
            take()
            value = take()[1:-1]
        if t == "local-name()":
            return lambda n: n.tag == value
        name = bare(t[1:])
        return (lambda n: name in n.attrs) if value is None else (lambda n: n.attrs.get(name) == value)

    return either()


def _one_path(root: Node, path: str) -> list[Node]:
    found, first = [root], True
    for axis, tag, test in _STEP.findall(path):
        fits = _condition(test) if test else (lambda n: True)
        out, seen = [], set()
        for base in found:
            deep = axis == "//" or (first and not axis)
            below = (n for n in base.walk() if n is not base) if deep else iter(base.children)
            for n in below:
                if id(n) not in seen and tag in ("*", n.tag) and fits(n):
                    seen.add(id(n))
                    out.append(n)
        found, first = out, False
    return found


def select(root: Node, xpath: str) -> list[Node]:
    """Nodes under root that any of the paths (joined by ``|``) finds, in document order."""
    paths = [p.strip() for p in xpath.split("|")]
    hits = {id(n) for p in paths for n in _one_path(root, p)}
    return [n for n in root.walk() if id(n) in hits]
