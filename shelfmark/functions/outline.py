"""The elements of a stored page, found in one scan with a stack of open elements.

Tags are balanced as browsers do for the pages at hand: void elements have no content, a list item, table cell or description
ends where the next one of the same list begins, a paragraph where a block begins, and an end tag closes everything
opened since its start tag. So an element holds its nested elements of the same name too.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

_TOKEN = re.compile(r"<!--.*?-->|<![^>]*>|<(/?)([A-Za-z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_STEP = re.compile(r"([\w-]*)((?:#[\w-]+|\.[\w-]+|\[[^\]]+\])*)$")
_PART = re.compile(r"#([\w-]+)|\.([\w-]+)|\[([\w-]+)(\*?)=[\"']?([^\"'\]]*)[\"']?\]")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
# an element that begins ends open ones of these names, up to the next open container
_ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"})}
_ENDS |= {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})} | {x: ({"p"}, {"button", "td", "th"}) for x in _BLOCKS}


class Element:
    """A tag with its attributes, its place in the page and the range of text pieces inside."""

    __slots__ = ("tag", "attributes", "parent", "begin", "end", "first", "last")

    def __init__(self, tag: str, attributes: str, parent: Element | None, begin: int, first: int):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.begin, self.end, self.first, self.last = begin, None, first, None

    def get(self, name: str) -> str | None:
        if isinstance(self.attributes, str):
            found = {}
            for key, value in _ATTRIBUTE.findall(self.attributes):
                found.setdefault(key.lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value))
            self.attributes = found
        return self.attributes.get(name)


@lru_cache(maxsize=1000)
def _steps(selector: str) -> list[tuple[str, list[tuple[str, bool, str]]]]:
    """Tag and conditions (attribute, whether a part of it is enough, value) of each step; ``class`` means one of the classes."""
    steps = []
    for word in re.findall(r"(?:\[[^\]]*\]|\S)+", selector):
        tag, rest = _STEP.match(word).groups()
        parts = [("id", False, i) if i else ("class", False, c) if c else (name, bool(star), value) for i, c, name, star, value in _PART.findall(rest)]
        steps.append((tag.lower(), parts))
    return steps


def _fits(element: Element, step: tuple) -> bool:
    tag, parts = step
    if tag and element.tag != tag:
        return False
    for name, part, value in parts:
        own = element.get(name)
        if own is None or not (value in own.split() if name == "class" else value in own if part else value == own):
            return False
    return True


class Outline:
    """Elements in the order of their start tags, and the texts between tags (scripts and styles are no text)."""

    def __init__(self, html: str):
        self.html = html
        self.elements: list[Element] = []
        self.pieces: list[str] = []
        self.scripts: list[tuple[Element, str]] = []
        open_elements: list[Element] = []
        at = 0

        def close(count: int) -> None:
            for element in open_elements[len(open_elements) - count :]:
                element.end, element.last = len(self.elements), len(self.pieces)
            del open_elements[len(open_elements) - count :]

        while (token := _TOKEN.search(html, at)) is not None:
            if token.start() > at:
                self.pieces.append(unescape(html[at : token.start()]))
            at = token.end()
            slash, tag, attributes = token.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                depth = next((k for k in range(len(open_elements) - 1, -1, -1) if open_elements[k].tag == tag), None)
                if depth is not None:
                    close(len(open_elements) - depth)
                continue
            if tag in _ENDS:
                ends, until = _ENDS[tag]
                for k in range(len(open_elements) - 1, -1, -1):
                    if open_elements[k].tag in until:
                        break
                    if open_elements[k].tag in ends and (tag != "td" or open_elements[k].tag != "tr"):
                        close(len(open_elements) - k)
                        break
            element = Element(tag, attributes, open_elements[-1] if open_elements else None, len(self.elements), len(self.pieces))
            self.elements.append(element)
            if tag in ("script", "style"):
                stop = re.compile(f"</{tag}\\s*>", re.I).search(html, at)
                self.scripts.append((element, html[at : stop.start() if stop else len(html)]))
                at = stop.end() if stop else len(html)
            if tag in _VOID or tag in ("script", "style") or attributes.endswith("/"):
                element.end, element.last = len(self.elements), len(self.pieces)
            else:
                open_elements.append(element)
        if at < len(html):
            self.pieces.append(unescape(html[at:]))
        close(len(open_elements))

    def all(self, selector: str, inside: Element | None = None) -> list[Element]:
        """Elements that fit the last step and have the others as ancestors, as in style sheets; alternatives by comma."""
        # names that the page holds nowhere need no search
        choices = [_steps(x) for x in selector.split(",")]
        choices = [steps for steps in choices if all(value in self.html for _, parts in steps for _, _, value in parts)]
        if not choices:
            return []
        rows = self.elements if inside is None else self.elements[inside.begin + 1 : inside.end]
        return [x for x in rows if any(self._reaches(x, steps) for steps in choices)]

    def first(self, selector: str, inside: Element | None = None) -> Element | None:
        return next(iter(self.all(selector, inside)), None)

    def _reaches(self, element: Element, steps: list) -> bool:
        if not _fits(element, steps[-1]):
            return False
        above = element.parent
        for step in reversed(steps[:-1]):
            while above is not None and not _fits(above, step):
                above = above.parent
            if above is None:
                return False
            above = above.parent
        return True

    def raw_text(self, element: Element | None) -> str:
        return "" if element is None else "".join(self.pieces[element.first : element.last])

    def text(self, element: Element | None) -> str | None:
        """Text of an element with single spaces; None without any."""
        return " ".join(self.raw_text(element).split()) or None

    def next_sibling(self, element: Element) -> Element | None:
        following = self.elements[element.end] if element.end < len(self.elements) else None
        return following if following is not None and following.parent is element.parent else None
