"""Elements of one page and selectors over them, a helper that runs inside tasks.

``Page`` reads the tags of a document once and keeps, for every element, its name, attributes, parent, place
among its siblings, the end of its subtree and its direct text nodes.  A stack follows the open elements, so
they nest to any depth.

* Comments, scripts and styles hold no text.  Void elements have no content.
* An element whose end tag HTML lets you omit (p, li, td, th, tr, thead, tbody, tfoot) ends where a following
  sibling begins or an element around it ends; tables inside cells and lists inside items are not crossed.
* Any other element without an end tag ends with the element around it, whose text nodes then include its own.
* An end tag without a start tag is skipped.
"""

from __future__ import annotations

import re
from bisect import bisect_left

_TOKEN = re.compile(
    r"""(?is)<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<([a-z][a-z0-9:-]*+)"""
    r"""((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>|</([a-z][a-z0-9:-]*+)[^>]*+>|<[!?/][^>]*+>""")
_ATTRIBUTE = re.compile(r"""(?s)([^\s"'=/>][^\s=/>]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_BLOCKS = ("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
           "nav ol p pre section table ul").split()
#: Start tags that end an open element, and the elements whose start tags they do not cross.
_ENDED_BY = {
    **{tag: (("p",), ("td", "th", "li", "div", "section", "article", "body")) for tag in _BLOCKS},
    "li": (("li",), ("ul", "ol", "menu")),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "thead": (("tbody", "tfoot", "tr", "td", "th"), ("table",)),
}
_OMITTABLE = frozenset("p li td th tr thead tbody tfoot".split())


class Element:
    __slots__ = ("name", "raw", "parent", "end", "number", "place", "last", "texts", "_attrs")

    def __init__(self, name: str, raw: str, parent: int, place: int, number: int):
        self.name, self.raw, self.parent, self.place, self.number = name, raw, parent, place, number
        self.end, self.last, self.texts, self._attrs = 0, True, [], None

    @property
    def attrs(self) -> dict[str, str | None]:
        """Attributes by lower-case name, the first of a name counts, values as written."""
        if self._attrs is None:
            self._attrs = {}
            for m in _ATTRIBUTE.finditer(self.raw):
                self._attrs.setdefault(m[1].lower(), next((v for v in m.group(2, 3, 4) if v is not None), ""))
        return self._attrs


class Page:
    """The elements of one document in document order; element 0 stands for the document itself."""

    def __init__(self, html: str | None):
        html = html or ""
        self.elements = [Element("", "", -1, 0, 0)]
        self.by_name: dict[str, list[int]] = {}
        stack, seen, last_child = [0], [{}], [-1]
        done = 0
        for m in _TOKEN.finditer(html):
            self._text(stack, html, done, m.start())
            done = m.end()
            if m[2]:
                name = m[2].lower()
                self._end_omitted(stack, seen, last_child, name)
                self._open(stack, seen, last_child, name, m[3])
            elif m[4]:
                self._close(stack, seen, last_child, m[4].lower())
        self._text(stack, html, done, len(html))
        for i in stack:
            self.elements[i].end = len(self.elements)

    def _text(self, stack, html, start, end):
        if end > start:
            self.elements[stack[-1]].texts.append(html[start:end])

    def _open(self, stack, seen, last_child, name, raw):
        counts, i = seen[-1], len(self.elements)
        counts[name] = counts.get(name, 0) + 1
        counts[""] = counts.get("", 0) + 1
        self.elements.append(Element(name, raw, stack[-1], counts[""], counts[name]))
        self.by_name.setdefault(name, []).append(i)
        if last_child[-1] >= 0:
            self.elements[last_child[-1]].last = False
        last_child[-1] = i
        if name in _VOID:
            self.elements[i].end = i + 1
        else:
            stack.append(i)
            seen.append({})
            last_child.append(-1)

    def _pop(self, stack, seen, last_child, down_to: int):
        """End the open elements above and at ``down_to``; those without an end tag of their own pass their texts on."""
        while len(stack) > down_to:
            e = self.elements[stack.pop()]
            e.end = len(self.elements)
            seen.pop()
            last_child.pop()
            if len(stack) > down_to and e.name not in _OMITTABLE:
                self.elements[stack[-1]].texts.extend(e.texts)

    def _end_omitted(self, stack, seen, last_child, name):
        ended, walls = _ENDED_BY.get(name, ((), ()))
        found = 0
        for at in range(len(stack) - 1, 0, -1):
            open_name = self.elements[stack[at]].name
            if open_name in walls:
                break
            if open_name in ended:
                found = at
        if found:
            self._pop(stack, seen, last_child, found)

    def _close(self, stack, seen, last_child, name):
        wall = "table" if name in ("td", "th", "tr", "thead", "tbody", "tfoot") else None
        for at in range(len(stack) - 1, 0, -1):
            open_name = self.elements[stack[at]].name
            if open_name == name:
                self._pop(stack, seen, last_child, at)
                return
            if open_name == wall:
                return

    def inside(self, name: str | None, start: int, end: int) -> list[int]:
        """Elements of that name (any: None) numbered ``start`` up to ``end``."""
        if name is None:
            return list(range(max(start, 1), end))
        own = self.by_name.get(name, [])
        return own[bisect_left(own, start):bisect_left(own, end)]

    def select(self, chain: tuple[Selector, ...], start: int = 0) -> list[int]:
        """Elements found from one element by selectors, each within what the one before found."""
        found = [start]
        for selector in chain:
            found = selector.find(self, found)
        return found

    def values(self, chain: tuple[Selector, ...], start: int = 0) -> list[str | None]:
        """Texts or attribute values that the last selector of the chain asks for, as written, in document order."""
        out: list[str | None] = []
        last = chain[-1]
        for i in self.select(chain, start):
            e = self.elements[i]
            out += e.texts if last.attribute is None else [e.attrs.get(last.attribute)]
        return out


_STEP = re.compile(r"""\s*(>)?\s*((?:[a-zA-Z][\w-]*|\*)?(?:\.[\w-]+|\[\w[\w-]*\*?="[^"]*"\]|:first-child|:last-child)*)""")
_TEST = re.compile(r"""\.([\w-]+)|\[(\w[\w-]*)(\*?)="([^"]*)"\]|:(first|last)-child""")
_PATH_STEP = re.compile(r"/([a-zA-Z][\w-]*)(?:\[(\d+)\])?")


class Selector:
    """One selector, compiled from its text.

    Either steps of ``name.class[attribute="value"][attribute*="part"]:first-child:last-child`` parted by blanks
    (inside) or ``>`` (child of), ending in ``::text`` (the default) or ``::attr(name)``; or an absolute path
    ``/name/name[n]`` from the document, ``n`` counting siblings of that name.  The first step may be the
    element that the search begins at.
    """

    def __init__(self, text: str):
        body, _, value = text.partition("::")
        self.attribute = value[5:-1].strip().lower() if value.startswith("attr(") else None
        if value not in ("", "text") and not (value.startswith("attr(") and value.endswith(")")):
            raise ValueError(f"selector {text!r}: unknown ::{value}")
        self.path = None
        if body.startswith("/"):
            parts = _PATH_STEP.findall(body)
            if "".join(f"/{n}" + (f"[{k}]" if k else "") for n, k in parts) != body:
                raise ValueError(f"selector {text!r}: not a path of names and positions")
            self.path = [(n.lower(), int(k) if k else None) for n, k in parts]
            return
        self.steps, at, body = [], 0, body.strip()
        while at < len(body):
            m = _STEP.match(body, at)
            if not m or not m[2]:
                raise ValueError(f"selector {text!r}: cannot read {body[at:]!r}")
            name = re.match(r"[a-zA-Z][\w-]*", m[2])
            self.steps.append((bool(m[1]), name[0].lower() if name else None, _TEST.findall(m[2])))
            at = m.end()
        if not self.steps or self.steps[0][0]:
            raise ValueError(f"selector {text!r}: no first step")

    @staticmethod
    def _meets(e: Element, tests) -> bool:
        for cls, attribute, part, value, side in tests:
            if cls:
                ok = cls in (e.attrs.get("class") or "").split()
            elif attribute:
                own = e.attrs.get(attribute.lower())
                ok = own is not None and (value in own if part else own == value)
            else:
                ok = e.place == 1 if side == "first" else e.last
            if not ok:
                return False
        return True

    def find(self, page: Page, starts: list[int]) -> list[int]:
        if self.path is not None:
            found = [0] if starts else []
            for name, number in self.path:
                found = [j for i in found for j in page.inside(name, i + 1, page.elements[i].end)
                         if page.elements[j].parent == i and number in (None, page.elements[j].number)]
            return found
        found = starts
        for step, (child, name, tests) in enumerate(self.steps):
            out: list[int] = []
            if child:
                out = sorted({j for i in found for j in page.inside(name, i + 1, page.elements[i].end)
                              if page.elements[j].parent == i and self._meets(page.elements[j], tests)})
            else:
                done = 0
                for i in found:
                    end = page.elements[i].end
                    if end > done:
                        out += [j for j in page.inside(name, max(i + (step > 0), done), end)
                                if self._meets(page.elements[j], tests)]
                        done = end
            found = out
        return found


def compiled(chain: str | tuple[str, ...]) -> tuple[Selector, ...]:
    return tuple(Selector(t) for t in ((chain,) if isinstance(chain, str) else chain))
