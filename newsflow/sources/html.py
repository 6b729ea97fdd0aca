"""A small HTML tree and selector engine on the standard library, for use inside Arrow functions.

Selectors: tag, *, .class, #id, [attr], [attr=v], [attr*=v], [attr~=v], [attr^=v], compounds of
these, descendants (space), children (>), and comma lists. Class names may hold escaped signs.
Broken markup gives the tree that implicit end tags make of it; nothing raises, and no page ends before its end.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, blocks that end a paragraph, siblings that end each other.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCK = ENDS_P | {"li", "tr", "td", "th", "body", "title", "figcaption", "dt", "dd"}
HIDDEN = frozenset(("script", "style", "template", "noscript"))
# Where a comment ends, and where an element of raw text does.
ENDS_COMMENT = re.compile(r"--(?:\s*|!)>")
ENDS_RAW = {tag: re.compile(rf"</\s*{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style")}
# A decimal character reference: leading zeros, the digits that tell that it is too large, more digits.
REFERENCE = re.compile(r"&#0*([0-9]{1,8})[0-9]*")


class Node:
    __slots__ = ("attrs", "children", "index", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.index: dict | None = None

    def walk(self):
        """All elements below, in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def free(self) -> None:
        """Takes the tree below apart: its links go both ways, so it would else stay until the next collection of garbage."""
        for node in list(self.walk()):
            node.parent = node.index = None
        self.children, self.index = [], None

    def raw_text(self, skip: frozenset[str] = frozenset()) -> str:
        """All text below as it stands."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in skip:
                stack.extend(reversed(x.children))
        return "".join(out)

    def text(self) -> str:
        """Text as shown: white space collapsed, <br> and blocks as line breaks, scripts and styles left out."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if x is None:
                out.append("\n")
            elif isinstance(x, str):
                out.append(re.sub(r"\s+", " ", x))
            elif x.tag == "br":
                out.append("\n")
            elif x.tag not in HIDDEN:
                if x.tag in BLOCK:
                    out.append("\n")
                    stack.append(None)
                stack.extend(reversed(x.children))
        lines = (re.sub(" +", " ", line).strip() for line in "".join(out).split("\n"))
        return re.sub("\n+", "\n", "\n".join(lines)).strip()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.at = self.root

    def _open(self, node):
        self.at = node

    def _close(self, node):
        self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._leave({"p"}, {"div", "article", "section", "td", "body", "button"})
        if tag in LIKE:
            self._leave(LIKE[tag], {"ul", "ol", "dl", "table", "select"} | ({"tr"} if tag in ("td", "th") else set()))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self._open(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _leave(self, tags, until):
        node = self.at
        while node.parent is not None and node.tag not in until:
            if node.tag in tags:
                self._close(node)
                return
            node = node.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self._close(node)
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)

    # As the HTML standard has it, so that a page goes on behind what html.parser raises at or doesn't see the end of.

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i, report)

    def parse_comment(self, i, report=1):
        start = i + len("<!--")
        end = re.compile("-?>").match(self.rawdata, start) or ENDS_COMMENT.search(self.rawdata, start)
        return end.end() if end else -1

    def set_cdata_mode(self, elem, **how):
        super().set_cdata_mode(elem, **how)
        self.interesting = ENDS_RAW.get(self.cdata_elem, self.interesting)

    def parse_endtag(self, i):
        end = self.rawdata.find(">", i) + 1
        if self.cdata_elem not in ENDS_RAW or not end:
            return super().parse_endtag(i)
        self.handle_endtag(self.cdata_elem)
        self.clear_cdata_mode()
        return end

    def close(self):
        super().close()
        if self.rawdata:  # a script that is still open
            self.handle_data(self.rawdata)
            self.rawdata = ""


def parse(html: str | None) -> Node | None:
    """The tree of a document; None for null or blank input."""
    if not html or not html.strip():
        return None
    return _fed(_Builder, html).root


def _fed(kind: type[_Builder], html: str) -> _Builder:
    """The whole page, read. A character reference of more digits than an int takes raises, then all are shortened, which changes no sign."""
    builder = kind()
    try:
        builder.feed(html)
        builder.close()
    except ValueError:
        builder.root.free()
        builder = kind()
        builder.feed(REFERENCE.sub(r"&#\1", html))
        builder.close()
    return builder


class _Rows(_Builder):
    """The rows of all tables, each taken as it ends: of the tree only the open elements and what is in the outermost open row are there."""

    def __init__(self):
        super().__init__()
        self.stack: list[Node] = []
        self.found: list[list[list[str]]] = []
        self.of: dict[Node, list[list[str]]] = {}  # rows of tables that are open or in the row
        self.row: Node | None = None
        self.over: list[list[list[str]]] = []  # rows of the tables around the row

    def _open(self, node):
        super()._open(node)
        self.stack.append(node)
        if node.tag == "table":
            self.found.append([])
            self.of[node] = self.found[-1]
        elif node.tag == "tr" and self.row is None:
            self.row, self.over = node, list(self.of.values())

    def _close(self, node):
        super()._close(node)
        row, last = None, None
        while last is not node:
            last = self.stack.pop()
            if last is self.row:
                row = last
            if row is not None or self.row is None:
                self.of.pop(last, None)
        if row is not None:
            self._take()
        if self.row is None:
            self.at.children.clear()

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if self.row is None:
            self.at.children.clear()

    def handle_data(self, data):
        if self.row is not None:
            super().handle_data(data)

    def _take(self):
        below = list(self.row.walk())
        for row in (self.row, *(n for n in below if n.tag == "tr")):
            cells = [c.text() for c in row.walk() if c.tag in ("td", "th")]
            for rows in self.over:
                rows.append(cells)
            up = row
            while up is not self.row:
                up = up.parent
                if up.tag == "table":
                    self.of[up].append(cells)
        for node in below:
            self.of.pop(node, None)
        self.row.free()
        self.row = None


def page_tables(html: str | None) -> list[list[list[str]]]:
    """``tables`` of a page of any length, without its tree."""
    if not html or not html.strip():
        return []
    rows = _fed(_Rows, html)
    if rows.row is not None:
        rows._take()
    return rows.found


_PART = re.compile(r"""(?P<tag>\*|[A-Za-z][\w-]*)|\#(?P<id>(?:\\.|[\w-])+)|\.(?P<cls>(?:\\.|[\w-])+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*~^$]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]*))\s*)?\]|(?P<child>\s*>\s*)|(?P<down>\s+)""")


def compile_selector(selector: str) -> list[list[tuple[str, list[tuple]]]]:
    """Alternatives of steps (how it hangs on the step before, tests); an unreadable alternative matches nothing."""
    out = []
    for text in re.split(r",(?![^\[]*\])", selector):
        steps, tests, how, at, text = [], [], "down", 0, text.strip()
        while at < len(text):
            m = _PART.match(text, at)
            if not m:
                steps, tests = [], []
                break
            at = m.end()
            if m["child"] or m["down"]:
                steps.append((how, tests))
                how, tests = ("child" if m["child"] else "down"), []
            elif m["tag"]:
                tests.append(("tag", m["tag"].lower()))
            elif m["id"]:
                tests.append(("attr", "id", "=", re.sub(r"\\(.)", r"\1", m["id"])))
            elif m["cls"]:
                tests.append(("attr", "class", "~=", re.sub(r"\\(.)", r"\1", m["cls"])))
            else:
                value = next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), "")
                tests.append(("attr", m["attr"].lower(), m["op"] or "", value))
        if tests:
            out.append([*steps, (how, tests)])
    return out


def _passes(node: Node, tests: list[tuple]) -> bool:
    for t in tests:
        if t[0] == "tag":
            if t[1] not in ("*", node.tag):
                return False
            continue
        have = node.attrs.get(t[1])
        if have is None:
            return False
        op, want = t[2], t[3]
        fine = {"": True, "=": have == want, "~=": want in have.split(), "*=": bool(want) and want in have, "^=": bool(want) and have.startswith(want), "$=": bool(want) and have.endswith(want)}[op]
        if not fine:
            return False
    return True


def _reaches(node: Node, steps: list[tuple[str, list[tuple]]]) -> bool:
    how, tests = steps[-1]
    if not _passes(node, tests):
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    while up is not None and up.tag != "#root":
        if _reaches(up, steps[:-1]):
            return True
        if how == "child":
            return False
        up = up.parent
    return False


#: Selectors that a worker keeps compiled.
_compiled = lru_cache(maxsize=4096)(compile_selector)


def _index(root: Node) -> dict:
    """The elements below by tag, id, class and attribute name, each with its place in the document: one walk, kept with the root."""
    if root.index is None:
        found = root.index = {"*": []}
        for place, node in enumerate(root.walk()):
            here = (place, node)
            found["*"].append(here)
            found.setdefault(("tag", node.tag), []).append(here)
            for name, value in node.attrs.items():
                found.setdefault(("attr", name), []).append(here)
                if name == "id":
                    found.setdefault(("id", value), []).append(here)
                elif name == "class":
                    for c in set(value.split()):
                        found.setdefault(("class", c), []).append(here)
    return root.index


def _key(test: tuple):
    """Where the index has what a test takes, and perhaps more."""
    if test[0] == "tag":
        return "*" if test[1] == "*" else test
    name, how, value = test[1:]
    return ("id", value) if (name, how) == ("id", "=") else ("class", value) if (name, how) == ("class", "~=") else ("attr", name)


def select(root: Node, selector: str | list) -> list[Node]:
    """Elements that a selector (text or compiled) takes, in document order. Only those are tried that have the rarest tag, id, class or attribute that the selector asks of them."""
    index, found = _index(root), {}
    for steps in _compiled(selector) if isinstance(selector, str) else selector:
        some = min((index.get(_key(t), ()) for t in steps[-1][1]), key=len)
        found.update((place, node) for place, node in some if place not in found and _reaches(node, steps))
    return [found[place] for place in sorted(found)]


def search(root: Node, selectors: list[str], attributes: list[str] = (), every: bool = True, most: int | None = None, raw: bool = False, exclude: list[str] = ()) -> list[str]:
    """Values of what the selectors take: attributes if any are asked for and present, else texts.

    every: values of all selectors, else of the first one with hits; most: the first so many; exclude:
    elements inside these selectors are left out. Blank values don't count.
    """
    gone = {id(n) for s in exclude for n in select(root, s)}
    out: list[str] = []
    for s in selectors:
        found = []
        for node in select(root, s):
            up = node
            while up is not None and id(up) not in gone:
                up = up.parent
            if up is None:
                values = [node.attrs[a] for a in attributes if node.attrs.get(a)]
                found += values or ([] if attributes else [node.raw_text(HIDDEN) if raw else node.text()])
        out += [v for v in found if v.strip()]
        if out and not every:
            break
    return out[:most] if most else out


def tables(root: Node) -> list[list[list[str]]]:
    """Every table as rows of cell texts."""
    return [[[c.text() for c in row.walk() if c.tag in ("td", "th")] for row in select(t, "tr")] for t in select(root, "table")]
