"""HTML documents as a small tree, selectors over it, and its Markdown.

Built on the tokenizer of the standard library. Void elements and implied end
tags (``p``, ``li``, table parts) are handled; unknown selectors raise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from docmill.functions.markdown import ANCHOR_MARK

# Elements without content, and the start tags that end an open one.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}}
_BLOCK = frozenset("address article aside blockquote body center details dialog div dl dt dd fieldset figure figcaption footer form header html main nav ol p section summary table ul".split())
_CONTAINERS = (_BLOCK | {"td", "th", "li", "button"}) - {"p"}
_INVISIBLE = frozenset("script style head template noscript title".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Node | str] = []

    def descendants(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            else:
                stack.extend(reversed(node.children))

    def text(self, joint: str = "") -> str:
        return joint.join(self.strings())

    def position(self) -> int:
        return next(k for k, c in enumerate(self.parent.children) if c is self)

    def replace(self, *others: Node | str) -> None:
        at = self.position()
        for other in others:
            if isinstance(other, Node):
                other.parent = self.parent
        self.parent.children[at : at + 1] = others
        self.parent = None

    def insert_before(self, other: Node) -> None:
        other.parent = self.parent
        self.parent.children.insert(self.position(), other)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#document")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._imply(tag)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def _imply(self, tag: str) -> None:
        """Close the elements that ``tag`` ends, up to the container that bounds them."""
        bounds = _SCOPE.get(tag, _CONTAINERS)
        node = self.at
        while node.parent is not None and node.tag not in bounds:
            if tag in _CLOSED_BY.get(node.tag, ()):
                self.at = node.parent
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse_html(text: str) -> Node:
    builder = _Builder()
    builder.feed(text)
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"([A-Za-z][\w-]*|\*)|\.([\w-]+)|#([\w:.-]+)|\[\s*([\w:-]+)\s*(?:([~^$*|]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]")


def _compound(text: str) -> Callable[[Node], bool]:
    tests: list[Callable[[Node], bool]] = []
    at = 0
    while at < len(text):
        m = _SIMPLE.match(text, at)
        if not m:
            raise ValueError(f"unsupported selector {text!r}")
        tag, cls, ident, attr, op, value = m.groups()
        if tag:
            tests.append(lambda n, tag=tag.lower(): tag == "*" or n.tag == tag)
        elif cls:
            tests.append(lambda n, cls=cls: cls in n.classes())
        elif ident:
            tests.append(lambda n, ident=ident: n.attrs.get("id") == ident)
        else:
            wanted = (value or "").strip("\"'")
            checks = {
                None: lambda have, want: True, "=": lambda have, want: have == want, "^=": str.startswith, "$=": str.endswith,
                "*=": lambda have, want: want in have, "~=": lambda have, want: want in have.split(), "|=": lambda have, want: have == want or have.startswith(want + "-"),
            }
            tests.append(lambda n, attr=attr.lower(), check=checks[op], wanted=wanted: attr in n.attrs and check(n.attrs[attr], wanted))
        at = m.end()
    return lambda node: all(test(node) for test in tests)


class Selector:
    """CSS selectors: type, class, id and attribute tests, descendant and child steps, lists."""

    def __init__(self, text: str):
        self.paths = []
        for part in text.split(","):
            steps = re.findall(r">|[^\s>]+(?:\[[^\]]*\][^\s>]*)*", part.strip())
            if not steps:
                raise ValueError(f"empty selector {text!r}")
            path, direct = [], False
            for step in steps:
                if step == ">":
                    direct = True
                    continue
                path.append((direct, _compound(step)))
                direct = False
            self.paths.append(path)

    def matches(self, node: Node) -> bool:
        return any(self._ends(path, len(path) - 1, node) for path in self.paths)

    def _ends(self, path: list, k: int, node: Node) -> bool:
        if not path[k][1](node):
            return False
        if k == 0:
            return True
        above = node.parent
        while above is not None and above.tag != "#document":
            if self._ends(path, k - 1, above):
                return True
            if path[k][0]:
                return False
            above = above.parent
        return False

    def select(self, root: Node) -> list[Node]:
        return [node for node in root.descendants() if self.matches(node)]

    def first(self, root: Node) -> Node | None:
        return next((node for node in root.descendants() if self.matches(node)), None)


def one_line(text: str) -> str:
    """White space collapsed, none before brackets and commas, none after an opening bracket."""
    text = " ".join(text.split())
    return re.sub(r"\(\s+", "(", re.sub(r"\s+(?=[(),])", "", text))


class _Renderer:
    """Markdown of a tree: ATX headings, nothing escaped."""

    def __init__(self, keep_lines: bool = False) -> None:
        self.depth = 0
        self.keep_lines = keep_lines

    def inline(self, node: Node | str) -> str:
        """Children of inline content, white space collapsed (but not at the top of Markdown, whose lines count)."""
        if isinstance(node, str):
            return node if self.keep_lines else re.sub(r"[ \t\r\n\f]+", " ", node)
        return self.element(node)

    def contents(self, node: Node) -> str:
        return "".join(self.inline(child) for child in node.children)

    def element(self, node: Node) -> str:
        tag = node.tag
        if tag in _INVISIBLE:
            return ""
        if tag == "br":
            return "  \n"
        if tag == "hr":
            return "\n\n---\n\n"
        if tag == "img":
            return node.attrs.get("alt", "")
        if tag == "pre":
            body = node.text().strip("\n")
            run = "`" * max(3, 1 + max((len(m) for m in re.findall(r"`{3,}", body)), default=0))
            return f"\n\n{run}\n{body}\n{run}\n\n"
        if tag in HEADINGS:
            title = " ".join(self.contents(node).split())
            return f"\n\n{'#' * int(tag[1])} {title}\n\n" if title else "\n\n"
        if tag == "table":
            return self.table(node)
        if tag in ("ul", "ol", "menu"):
            return self.listing(node)
        inner = self.contents(node)
        if tag in ("strong", "b"):
            return self.wrapped(inner, "**")
        if tag in ("em", "i"):
            return self.wrapped(inner, "*")
        if tag in ("del", "s"):
            return self.wrapped(inner, "~~")
        if tag in ("code", "kbd", "samp", "tt"):
            return self.code(node)
        if tag == "a":
            return self.link(inner, node.attrs.get("href"), node.attrs.get("title"))
        if tag == "blockquote":
            quoted = "\n".join(f"> {line}".rstrip() for line in tidy(inner).split("\n"))
            return f"\n\n{quoted}\n\n"
        if tag in _BLOCK:
            return f"\n\n{inner.strip(' ')}\n\n"
        return inner

    def wrapped(self, inner: str, mark: str) -> str:
        core = inner.strip()
        if not core:
            return inner
        head, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        return f"{head}{mark}{core}{mark}{tail}"

    def code(self, node: Node) -> str:
        body = " ".join(node.text().split())
        if not body:
            return ""
        run = "`" * (1 + max((len(m) for m in re.findall(r"`+", body)), default=0))
        pad = " " if body[0] == "`" or body[-1] == "`" else ""
        return f"{run}{pad}{body}{pad}{run}"

    def link(self, inner: str, href: str | None, title: str | None) -> str:
        core = inner.strip()
        if not core or href is None:
            return inner
        head, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        if core == href and not title:
            return f"{head}<{href}>{tail}"
        named = f' "{title}"' if title else ""
        return f"{head}[{core}]({href}{named}){tail}"

    def listing(self, node: Node) -> str:
        self.depth += 1
        number = int(node.attrs.get("start", "1")) if node.attrs.get("start", "1").isdigit() else 1
        items = []
        for child in node.children:
            if isinstance(child, str):
                continue
            if child.tag != "li":
                items.append(tidy(self.element(child)))
                continue
            mark = f"{number}." if node.tag == "ol" else "*+-"[(self.depth - 1) % 3]
            number += 1
            body = tidy(self.contents(child))
            pad = " " * (len(mark) + 1)
            items.append(f"{mark} " + "\n".join(pad + line if line and k else line for k, line in enumerate(body.split("\n"))))
        self.depth -= 1
        edge = "\n" if self.depth else "\n\n"
        return edge + "\n".join(item for item in items if item.strip()) + edge

    def table(self, node: Node) -> str:
        rows: list[tuple[list[str], bool]] = []
        for row in (n for n in node.descendants() if n.tag == "tr"):
            above = row.parent
            while above is not node and above.tag != "table":
                above = above.parent
            if above is not node:
                continue  # a row of a table inside a cell
            cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
            texts = []
            for cell in cells:
                texts.append(" ".join(tidy(self.contents(cell)).split()))
                span = cell.attrs.get("colspan", "1")
                texts += [""] * (int(span) - 1 if span.isdigit() and 1 < int(span) <= 1000 else 0)
            if texts:
                rows.append((texts, all(c.tag == "th" for c in cells) or row.parent.tag == "thead"))
        if not rows:
            return self.contents(node)
        width = max(len(texts) for texts, _ in rows)
        if not rows[0][1]:
            rows.insert(0, ([""] * width, True))
        lines = ["| " + " | ".join(texts + [""] * (width - len(texts))) + " |" for texts, _ in rows]
        lines.insert(1, "| " + " | ".join(["---"] * width) + " |")
        return "\n\n" + "\n".join(lines) + "\n\n"


def tidy(text: str) -> str:
    """At most one blank line in a row outside code, none at the ends."""
    out: list[str] = []
    run = None
    for line in text.split("\n"):
        mark = re.match(r"\s*(`{3,})", line)
        if run is None:
            if not line.strip() and (not out or not out[-1].strip()):
                continue
            if mark:
                run = mark[1]
        elif line.strip() == run:
            run = None
        out.append(line if run is not None or mark else line.rstrip() + ("  " if line.endswith("  ") and line.strip() else ""))
    return "\n".join(out).strip()


def to_markdown(node: Node, keep_lines: bool = False) -> str:
    """Markdown of a tree; with ``keep_lines`` text outside tags is Markdown already."""
    renderer = _Renderer(keep_lines)
    if node.tag != "#document":
        return tidy(renderer.element(node))
    return renderer.contents(node) if keep_lines else tidy(renderer.contents(node))


def _anchor_of(heading: Node) -> str | None:
    """Anchor of a heading: its own id, one inside it, an ``a`` just before it, or its section's."""
    own = heading.attrs.get("id")
    if own:
        return own
    inner = next((n for n in heading.descendants() if n.attrs.get("id") is not None or n.tag == "a" and "name" in n.attrs), None)
    if inner is not None:
        named = inner.attrs.get("id") or inner.attrs.get("name")
        if named:
            return named
    before = None
    for sibling in heading.parent.children:
        if sibling is heading:
            break
        if isinstance(sibling, Node):
            before = sibling
    if before is not None and before.tag == "a":
        named = before.attrs.get("id") or before.attrs.get("name")
        if named:
            return named
    return heading.parent.attrs.get("id") if heading.parent.tag == "section" else None


def page_title(root: Node) -> str | None:
    """Text of the first ``title``."""
    named = next((n for n in root.descendants() if n.tag == "title"), None)
    return "".join(s.strip() for s in named.strings()) if named is not None else None


def page_markdown(text: str, content: str | None = None, drop: list[str] | None = None, flatten: list[str] | None = None, url: str = "") -> tuple[str | None, str]:
    """Title and Markdown of the content region of an HTML page.

    ``content`` selects the region (``body`` without it; a page without tags is
    its own region), ``drop`` what is removed inside, ``flatten`` what becomes a
    one-line code block. Listings of ``div.line`` in ``div.fragment`` become
    code, headings get anchor lines, links become absolute, images their
    alternative text. Raises ``ValueError`` if the region is not found.
    """
    root = parse_html(text)
    title = page_title(root)
    region = Selector(content).first(root) if content else next((n for n in root.descendants() if n.tag == "body"), None)
    if region is None:
        raise ValueError(f"content selector {content or 'body'!r} not found")

    def detached(node: Node) -> bool:
        while node is not None and node is not region:
            node = node.parent
        return node is None

    for selector in drop or []:
        for node in Selector(selector).select(region):
            if not detached(node):
                node.replace()
    for selector in flatten or []:
        for node in Selector(selector).select(region):
            if not detached(node):
                code = Node("pre")
                code.children = [one_line(node.text(" "))]
                node.replace(code)
    for listing in Selector("div.fragment").select(region):
        rows = [] if detached(listing) else Selector("div.line").select(listing)
        if rows:
            for number in Selector("span.lineno").select(listing):
                number.replace()
            code = Node("pre")
            code.children = ["\n".join(row.text().replace("\xa0", " ") for row in rows)]
            listing.replace(code)
    for node in list(region.descendants()):
        if node.tag in HEADINGS:
            target = _anchor_of(node)
            if target:
                mark = Node("p")
                mark.children = [ANCHOR_MARK + target]
                node.insert_before(mark)
        elif node.tag == "a" and "href" in node.attrs:
            node.attrs["href"] = _joined(url, node.attrs["href"])
    return title, to_markdown(region)


def _joined(base: str, target: str) -> str:
    try:
        return urljoin(base, target)
    except ValueError:  # a malformed target stays as it is
        return target
