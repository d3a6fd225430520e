"""A small element tree for one page, with the few selector forms that comment pages need."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INERT = frozenset(("script", "style"))
# A start tag of the key ends open elements of the values, up to the nearest container.
_ENDS_P = frozenset(
    "address article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "p pre section table ul".split()
)
_LISTS = frozenset(("ul", "ol"))


@dataclass(eq=False)
class Node:
    tag: str
    classes: str = ""
    parent: Node | None = None
    children: list = field(default_factory=list)


@dataclass(frozen=True)
class Selector:
    """``tag``, ``.class`` words, parts of the class attribute, under an optional ancestor."""

    tag: str | None = None
    class_word: str | None = None
    class_parts: tuple[str, ...] = ()
    within: Selector | None = None
    ignore_case: bool = False  # of class parts

    @classmethod
    def of(cls, text: str) -> Selector:
        """``tag``, ``tag.class``, ``.class``, ``tag[class*='part']``, and ``outer inner``."""
        outer = None
        for step in text.split():
            if "[class*=" in step:
                tag, _, part = step.partition("[class*=")
                outer = cls(tag or None, None, (part.rstrip("]").strip("'\""),), outer)
            else:
                tag, _, word = step.partition(".")
                outer = cls(tag or None, word or None, (), outer)
        return outer

    def matches(self, node: Node) -> bool:
        if self.tag and node.tag != self.tag:
            return False
        if self.class_word and self.class_word not in node.classes.split():
            return False
        classes = node.classes.lower() if self.ignore_case else node.classes
        if self.class_parts and not any(part in classes for part in self.class_parts):
            return False
        if self.within is None:
            return True
        above = node.parent
        while above is not None and not self.within.matches(above):
            above = above.parent
        return above is not None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def _close(self, tag: str, stop: frozenset = frozenset()) -> None:
        node = self.at
        while node is not self.root and node.tag != tag:
            if node.tag in stop:
                return
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._close("p")
        if tag == "li":
            self._close("li", _LISTS)
        node = Node(tag, next((v or "" for k, v in attrs if k == "class"), ""), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _walk(node: Node):
    """Nodes and texts below ``node`` in document order, without recursion."""
    stack = list(reversed(node.children))
    while stack:
        item = stack.pop()
        yield item
        if isinstance(item, Node) and item.tag not in _INERT:
            stack.extend(reversed(item.children))


def select(node: Node, selector: Selector) -> list[Node]:
    return [n for n in _walk(node) if isinstance(n, Node) and selector.matches(n)]


def text_of(node: Node, sep: str) -> str:
    """Every text below ``node`` stripped, empty ones dropped, joined by ``sep``."""
    texts = (t.strip() for t in _walk(node) if isinstance(t, str))
    return sep.join(t for t in texts if t)
