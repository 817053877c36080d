"""Markup residue: detect it by family and turn texts into clean text.

``clean_text`` strips HTML, Markdown, wiki and LaTeX syntax and keeps structure
in one light form: ``#`` headings, ``-`` or ``1.`` list items, fenced code,
``a | b`` table rows and ``$`` formulas. ``keep_between`` then applies the
line-block distribution to the stripped lines: text lengths are summed over
sliding windows of lines, a surge opens and a dive closes a stretch of text, and
what lies outside every stretch (menus, crumbs, leftovers) is dropped. Text is
what is read, not what is clicked: links and short labels in a row weigh nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAMILIES = ("html", "markdown", "wiki", "latex")
CLEAN_FIELDS = T.StructType(
    [T.StructField("families", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType())]
    + [T.StructField(n, T.IntegerType()) for n in ("n_chars", "n_clean_chars", "n_headings", "n_items", "n_code", "n_rows", "n_formulas", "n_dropped_lines")]
)

# Element names of HTML that are taken for tags.
_ELEMENTS = (
    "a abbr acronym address applet area article aside audio b base basefont bdi bdo big blink blockquote body br button canvas caption "
    "center cite code col colgroup data dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noframes "
    "noscript object ol optgroup option p param picture pre q s samp script section select small source span strike strong style sub summary "
    "sup svg table tbody td textarea tfoot th thead time title tr track tt u ul var video wbr"
).split()
# C++ attributes in double brackets, which are no wiki links.
_ATTRIBUTES = frozenset("assume carries_dependency deprecated fallthrough indeterminate likely maybe_unused no_unique_address nodiscard noreturn unlikely".split())
# LaTeX commands that stand without an argument.
_BARE = "item hline centering maketitle noindent newpage clearpage tableofcontents appendix bigskip medskip smallskip newline par toprule midrule bottomrule LaTeX TeX"
# LaTeX commands whose argument is no text.
_SILENT = "cite citep citet ref eqref autoref cref label input include includegraphics usepackage documentclass bibliography bibliographystyle vspace hspace pageref index"

_LINE_ENDS = re.compile("\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]")
_CODE = re.compile(
    r"^[ \t]*(?P<fence>`{3,}|~{3,})(?P<info>[^\n`]*)(?:\n(?P<body>.*?))??(?:^[ \t]*(?P=fence)[`~]*[ \t]*$|\Z)|<pre\b[^<>]*>(?P<pre>.*?)(?:</pre\s*>|\Z)",
    re.I | re.M | re.S,
)
_TICKS = re.compile(r"(?<!`)(`{1,2})(?!`)([^`\n]+?)(?<!`)\1(?!`)")
_MATH_BLOCK = re.compile(
    r"\\begin\{(?P<env>equation|align|gather|multline|eqnarray|displaymath|math)(?P<star>\*?)\}(?:(?!\\begin\{(?P=env)).)*?\\end\{(?P=env)(?P=star)\}|\$\$.+?\$\$|\\\[(?:(?!\\[\[\]]).)+\\\]|\\\((?:(?!\\[()]).)+\\\)", re.S
)
_MATH_INLINE = re.compile(r"(?<![\\$\w])\$(?![\s$])([^$\n]*?[^\s$\\])\$(?![\d$])")
_MATH_LIKE = re.compile(r"[\\^_={}<>+*/]|^[A-Za-z]'*$|^\d+$|^[A-Za-z]\([^)]*\)$")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_TAG = re.compile(rf"<(/?)({'|'.join(sorted(_ELEMENTS, key=len, reverse=True))})(?=[\s/>])((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)>", re.I)
_DECLARATION = re.compile(r"<!doctype\b[^<>]*>|<\?xml\b[^<>]*\?>|<!\[CDATA\[|\]\]>", re.I)
_REFERENCE = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|([A-Za-z][A-Za-z0-9]{1,31}));")
_HIDDEN = re.compile(r"<(script|style)\b[^<>]*>(?:(?!<\1\b).)*?</\1\s*>", re.I | re.S)
_ANCHOR = re.compile(r"<a\s[^<>]*>([^<>\n]+)</a", re.I)
_ALT = re.compile(r"\balt\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*))", re.I)
_WIKI_HEADING = re.compile(r"^(={2,6})[ \t]*([^=\n](?:[^\n]*?[^=\n])?)[ \t]*\1[ \t]*$", re.M)
_WIKI_LINK = re.compile(r"\[\[(?![\s\-])([^\[\]\n]+)\]\]")
_WIKI_TEMPLATE = re.compile(r"\{\{\s*[A-Za-z#][^{}]*\}\}")
_WIKI_QUOTES = re.compile(r"(?<!')('{5}|'{3}|'{2})(?=[^'\s])([^'\n]*(?:'[^'\n]+)*?)(?<=[^'\s])\1(?!')")
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|[^\n]*$.*?(?:^[ \t]*\|\}[ \t]*$|\Z)", re.M | re.S)
_LATEX = re.compile(rf"(?<![\w:\\/])\\(?:([A-Za-z]{{2,}})\*?(?:\[[^\]\n]*\])?\s?\{{([^{{}}\n]*)\}}|({'|'.join(_BARE.split())})(?![A-Za-z]))[ \t]*")
_LATEX_HEADING = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_LATEX_ESCAPE = re.compile(r"(?<!\\)\\([%&#_{}])")
_ATX = re.compile(r"^[ \t]{0,3}(#{1,6})[ \t]+(?=\S)", re.M)
_SETEXT = re.compile(r"^(?![ \t]*(?:[>|#=\-]|[*+][ \t]))[ \t]{0,3}(\S[^\n]*)\n[ \t]{0,3}(=+|-{2,})[ \t]*$", re.M)
_BULLET = re.compile(r"^[ \t]*[*+\-][ \t]+(?=\S)", re.M)
_NUMBER = re.compile(r"^[ \t]*(\d{1,9})[.)][ \t]+(?=\S)", re.M)
_QUOTE = re.compile(r"^[ \t]{0,3}>(?!>>)(?:[ \t]|(?=[A-Za-z\n])|$)", re.M)
_IMAGE = re.compile(r"!\[([^\]\n]*)\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*(?:[ \t]+[\"'(][^\n]*?[\"')])?[ \t]*\)")
_LINK = re.compile(r"(?<![\w!\])])\[([^\[\]\n]+)\]\([ \t]*<?[^()\s]*(?:\([^()\s]*\)[^()\s]*)*>?(?:[ \t]+[\"'(][^\n]*?[\"')])?[ \t]*\)")
_DELIMITER = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$|^[ \t]*\|[ \t]*:?-{2,}:?[ \t]*\|[ \t]*$", re.M)
_STARS = re.compile(r"(?<![\w*\\])(\*{1,3})(?![\s*])([^*\n]*[^\s*])\1(?![\w*])")
_UNDERSCORES = re.compile(r"(?<![\w\\])(_{1,3})(?![\s_])((?:[^\s_]|_(?=\w)|[^\S\n](?!_))+?)\1(?!\w)")
_DUNDER = re.compile(r"__[a-z]+(?:_[a-z]+)*__\Z")
# Special names of Python between double underscores.
_SPECIAL = frozenset("__init__ __main__ __name__ __file__ __call__ __doc__ __str__ __repr__ __len__ __iter__ __next__ __enter__ __exit__ __all__ __dict__ __class__ __new__ __del__ __getitem__ __setitem__ __eq__ __hash__ __version__".split())
_STRIKE = re.compile(r"(?<![~\w])~~(?![\s~])([^~\n]*[^\s~])~~(?![~\w])")
_HOLD = re.compile("\x00(\\d+)\x00")


class _Cleaner:
    """Strips one text; ``seen`` collects the families of what was stripped."""

    def __init__(self, text: str):
        self.seen: set[str] = set()
        self.held: list[str] = []
        self.links: set[str] = set()
        self.formulas = self.blocks = 0
        text = _LINE_ENDS.sub("\n", text.replace("\x00", ""))
        if "```" in text or "~~~" in text or "<pre" in text or "<PRE" in text or "<Pre" in text:
            text = _CODE.sub(self._code, text)
        if "`" in text:
            text = _TICKS.sub(self._ticks, text)
        if "\\" in text or "$$" in text:
            text = _MATH_BLOCK.sub(self._math, text)
        if "$" in text:
            text = _MATH_INLINE.sub(self._inline, text)
        text = self._wiki(text)
        if "<" in text or "&" in text:
            text = self._html(text)
        if "\\" in text:
            text = self._latex(text)
        text = self._markdown(text)
        while "\x00" in text:
            text = _HOLD.sub(lambda m: self.held[int(m[1])], text)
        self.text = text

    def _hold(self, value: str) -> str:
        self.held.append(value)
        return f"\x00{len(self.held) - 1}\x00"

    def _code(self, m: re.Match) -> str:
        self.blocks += 1
        if m["fence"]:
            self.seen.add("markdown")
            body, info = m["body"] or "", m["info"].strip()
        else:
            self.seen.add("html")
            body, info = html.unescape(_TAG.sub("", m["pre"])), ""
        return "\n" + self._hold(f"```{info}\n{body.strip(chr(10))}\n```") + "\n"

    def _ticks(self, m: re.Match) -> str:
        self.seen.add("markdown")
        return self._hold(m[2])

    def _math(self, m: re.Match) -> str:
        self.seen.add("latex")
        self.formulas += 1
        raw = m[0]
        if raw.startswith(("$$", "\\[", "\\(")):
            mark = "$" if raw.startswith("\\(") else "$$"
            return self._hold(f"{mark}{raw[2:-2].strip()}{mark}")
        return self._hold(f"$$\n{raw}\n$$")

    def _inline(self, m: re.Match) -> str:
        if not _MATH_LIKE.search(m[1]):
            return m[0]
        self.seen.add("latex")
        self.formulas += 1
        return self._hold(m[0])

    def _saw(self, family: str, value: str) -> str:
        self.seen.add(family)
        return value

    def _wiki(self, text: str) -> str:
        if "{|" in text:
            text = _WIKI_TABLE.sub(lambda m: self._saw("wiki", self._wiki_rows(m[0])), text)
        if "{{" in text:
            text = _WIKI_TEMPLATE.sub(lambda m: self._saw("wiki", ""), text)
        if "[[" in text:
            text = _WIKI_LINK.sub(self._wiki_link, text)
        if "''" in text:
            text = _WIKI_QUOTES.sub(lambda m: self._saw("wiki", m[2]), text)
        if "==" in text:
            text = _WIKI_HEADING.sub(lambda m: self._saw("wiki", self._heading(len(m[1]), m[2])), text)
        return text

    def _heading(self, level: int, title: str) -> str:
        return self._hold("#" * level + " ") + title

    def _wiki_link(self, m: re.Match) -> str:
        target = m[1]
        if re.match(r"[\w:]+", target)[0] in _ATTRIBUTES if re.match(r"[\w:]+", target) else False:
            return m[0]
        return self._saw("wiki", self._link(target.rpartition("|")[2]))

    def _link(self, label: str) -> str:
        self.links.add(label.strip())
        return label

    def _wiki_rows(self, table: str) -> str:
        rows: list[list[str]] = [[]]
        for line in table.split("\n")[1:]:
            line = line.strip()
            if line.startswith("|}"):
                continue
            if line.startswith("|-"):
                rows.append([])
            elif line.startswith("|+"):
                rows[-1].append(line[2:].strip())
            elif line.startswith(("|", "!")):
                rows[-1] += [cell.strip() for cell in re.split(r"\|\||!!", line[1:])]
            elif line and rows[-1]:
                rows[-1][-1] += " " + line
        return "\n".join(self._row(cells) for cells in rows if cells)

    def _row(self, cells: list[str]) -> str:
        return f" {self._hold('|')} ".join(cells) if len(cells) > 1 else f"{cells[0]} {self._hold('|')}"

    def _html(self, text: str) -> str:
        if "<" in text:
            text = _COMMENT.sub(lambda m: self._saw("html", " "), text)
            text = _HIDDEN.sub(lambda m: self._saw("html", " "), text)
            text = _DECLARATION.sub(lambda m: self._saw("html", " ") if m[0] != "]]>" else m[0], text)
            self.links.update(map(str.strip, _ANCHOR.findall(text)))
            text = _TAG.sub(self._tag, text)
        if "&" in text:
            text = _REFERENCE.sub(self._reference, text)
        return text

    def _tag(self, m: re.Match) -> str:
        self.seen.add("html")
        closing, name = bool(m[1]), m[2].lower()
        if len(name) == 2 and name[0] == "h" and name[1].isdigit():
            return "\n" if closing else "\n" + self._hold("#" * int(name[1]) + " ")
        if name in ("li", "dt", "dd"):
            return "" if closing else "\n" + self._hold("- ")
        if name in ("td", "th"):
            return "" if closing else self._hold(" | ")
        if name == "img":
            alt = _ALT.search(m[3])
            return next((g for g in alt.groups() if g), "") if alt else ""
        if name in ("tr", "table", "br", "p", "div", "ul", "ol", "dl", "section", "article", "blockquote", "hr", "header", "footer", "nav", "form", "figure", "caption", "thead", "tbody"):
            return "\n"
        return ""

    def _reference(self, m: re.Match) -> str:
        if m[1] and m[1] + ";" not in html5:
            return m[0]
        self.seen.add("html")
        return self._hold(html.unescape(m[0]))

    def _latex(self, text: str) -> str:
        n = 1
        while n:  # arguments may hold commands; every round removes some
            text, n = _LATEX.subn(self._command, text)
        return _LATEX_ESCAPE.sub(r"\1", text) if "latex" in self.seen else text

    def _command(self, m: re.Match) -> str:
        self.seen.add("latex")
        if m[3]:
            return self._hold("- ") if m[3] == "item" else "\n" if m[3] in ("newline", "par") else ""
        name, argument = m[1], m[2]
        tail = m[0][len(m[0].rstrip(" \t")) :]
        if name in _LATEX_HEADING:
            return self._heading(_LATEX_HEADING[name], argument) + "\n"
        if name in ("begin", "end") or name in _SILENT.split():
            return tail
        return argument + tail

    def _markdown(self, text: str) -> str:
        seen = self.seen
        if "|" in text:
            text, n = _DELIMITER.subn("\x00-\x00", text)
            if n:
                seen.add("markdown")
                text = text.replace("\x00-\x00\n", "").replace("\x00-\x00", "")
        if "==" in text or "--" in text:
            text = _SETEXT.sub(lambda m: self._saw("markdown", self._heading(1 if m[2][0] == "=" else 2, m[1])), text)
        if "#" in text:
            text = _ATX.sub(lambda m: self._saw("markdown", self._hold(m[1] + " ")), text)
        text = _BULLET.sub(lambda m: self._saw("markdown", self._hold("- ")), text)
        text = _NUMBER.sub(lambda m: self._saw("markdown", self._hold(f"{m[1]}. ")), text)
        if ">" in text:
            text = _QUOTE.sub(lambda m: self._saw("markdown", ""), text)
        if "](" in text:
            text = _IMAGE.sub(lambda m: self._saw("markdown", m[1]), text)
            text = _LINK.sub(lambda m: self._saw("markdown", self._link(m[1])), text)
        if "*" in text:
            text = _STARS.sub(lambda m: self._saw("markdown", m[2]), text)
        if "_" in text:
            text = _UNDERSCORES.sub(self._underscore, text)
        if "~~" in text:
            text = _STRIKE.sub(lambda m: self._saw("markdown", m[1]), text)
        return text

    def _underscore(self, m: re.Match) -> str:
        if m[0] in _SPECIAL or (len(m[1]) == 1 and not re.fullmatch(r"[\w\s,.'-]+", m[2])):
            return m[0]
        self.seen.add("markdown")
        return m[2]


_STRUCTURE = re.compile(r"(#{1,6} )|(- |\d{1,9}\. )|(.* \| .*|.*\|$|\|)|(.*\$)")
_MARK = re.compile(r"\s*(?:[-*+] |\d{1,9}\. )?")
_LABELS = re.compile(r"\s{0,2}[|·•»›>/]\s{1,2}|\s{3,}")
_CRUMBS = re.compile(r"\s[·•»›]\s")
_SENTENCE_END = (".", "!", "?", ":", ";", "。", "！", "？", "：")


def text_weight(line: str, links: set[str]) -> int:
    """Characters of running text, without white space, list mark and links.

    A line of nothing but links, and one of three or more short labels set
    apart by dots or arrows (menus, crumbs), weigh nothing.
    """
    body = line[_MARK.match(line).end() :]
    if links or _CRUMBS.search(body):
        labels = [label.strip() for label in _LABELS.split(body.strip(" |")) if label.strip()]
        if all(label in links for label in labels):
            return 0
        if len(labels) > 2 and _CRUMBS.search(body) and all(len(label.split()) < 6 and not label.endswith(_SENTENCE_END) for label in labels):
            return 0
    return len(body) - sum(map(str.isspace, body))


def keep_between(lines: list[str], links: frozenset[str] | set[str] = frozenset(), window: int = 3, surge: int = 40, floor: int = 20) -> list[bool]:
    """Which lines lie between a surge and the next dive of the line-block distribution.

    A block is the sum of the weights (:func:`text_weight`) of ``window`` lines
    from a line on. Text begins in a block that reaches ``surge``, with its
    first line of a full share, and ends where a block falls under ``floor``
    (or its part, for the shorter blocks at the end). Between two stretches
    only lines without weight are dropped. Code and formulas are kept wherever they stand and bridge a stretch without
    opening one; items after a line that ends with a colon weigh a full share;
    a heading stays if anything below it does, or nothing is below it. Blank
    lines take no part and are kept. Where no block reaches ``surge`` there is
    no text to tell apart, and all lines are kept.
    """
    filled = [k for k, line in enumerate(lines) if line.strip()]
    share = -(-surge // window)
    weights, solid, headings = [], [], []
    in_code = in_formula = led = False
    for k in filled:
        line = lines[k]
        fence = not in_formula and line.startswith("```")
        formula = not in_code and not fence and "$" in line
        opens = formula and line.strip() == "$$"
        fixed = in_code or fence or formula or in_formula
        in_code ^= fence
        in_formula ^= opens
        heading = not fixed and line.startswith("#") and _STRUCTURE.match(line) is not None
        weight = max(floor, len(line)) if fixed else 0 if heading else text_weight(line, links)
        item = _MARK.match(line).end() > len(line) - len(line.lstrip())
        if led and item and weight:
            weight = max(weight, share)
        elif not fixed:
            led = line.rstrip().endswith((":", "："))
        weights.append(weight)
        solid.append(fixed)
        headings.append(heading)
    kept = list(solid)
    inside = found = False
    last = -1
    total = sum(weights[:window])
    for at in range(len(filled)):
        if not inside and total >= surge and weights[at] >= share and not solid[at]:
            inside = found = True
            for gap in range(last + 1, at) if last >= 0 else ():
                kept[gap] |= weights[gap] > 0
        elif inside and total * window < floor * min(window, len(filled) - at):
            inside = False
        kept[at] |= inside
        last = at if inside else last
        total += (weights[at + window] if at + window < len(weights) else 0) - weights[at]
    keep = [True] * len(lines)
    if not found:
        return keep
    below = empty = True
    for at in reversed(range(len(filled))):
        if headings[at]:
            kept[at] = below or empty
            below, empty = False, True
        else:
            below, empty = (kept[at] or below) and not (empty and not kept[at]), False
        keep[filled[at]] = kept[at]
    return keep


def clean_text(text: str | None) -> tuple:
    """One row of ``CLEAN_FIELDS``; null gives an empty family list and null text."""
    if text is None:
        return [], None, 0, 0, 0, 0, 0, 0, 0, 0
    done = _Cleaner(text)
    lines = [line.rstrip() for line in done.text.split("\n")]
    keep = keep_between(lines, done.links)
    out, blank, counts, in_code = [], True, [0, 0, 0], False
    for line, kept in zip(lines, keep):
        if not line:
            if in_code:
                out.append(line)
            blank = True
            continue
        if not kept:
            continue
        if line.startswith("```"):
            in_code = not in_code
        elif not in_code and (m := _STRUCTURE.match(line)):
            if m.lastindex <= 3:
                counts[m.lastindex - 1] += 1
        if blank and out and not in_code:
            out.append("")
        blank = False
        out.append(line if in_code or line.startswith(("    ", "\t")) else line.strip() if line.startswith(" ") else line)
    cleaned = "\n".join(out)
    families = [f for f in FAMILIES if f in done.seen]
    return families, cleaned, len(text), len(cleaned), counts[0], counts[1], done.blocks, counts[2], done.formulas, len(keep) - sum(keep)


def clean_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without column ``text``, with the columns of ``CLEAN_FIELDS``.

    One row per input row, no shuffle. Null text gives null ``clean_text`` and
    no families; empty text gives empty text. Columns of ``df`` with the same
    names as the new ones are replaced.
    """
    made = CLEAN_FIELDS.names
    kept = [c for c in df.columns if c not in {text, *made}]
    source = df.select(*kept, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *CLEAN_FIELDS.fields])
    types = [pa.list_(pa.string()), pa.string(), *[pa.int32()] * 8]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [clean_text(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    return source.mapInArrow(clean, schema)


def found_families(df: DataFrame) -> DataFrame:
    """Distinct ``(id, family)`` of the markup that cleaning stripped."""
    cleaned = clean_documents(df.select("id", "text"))
    return cleaned.select("id", F.explode("families").alias("family")).distinct()
