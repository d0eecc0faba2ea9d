"""Visible text of HTML pages, laid out: a tree with implied tags, then a rendering of its blocks.

The tree builder closes what HTML lets authors leave open (``p`` before blocks, ``li``, ``dt``,
``dd``, ``option``, table rows, cells and sections) and ignores stray end tags. Hidden are the
elements that browsers don't paint (head, script, style, template, ...), the ``hidden``
attribute, ``display:none`` styles, closed ``dialog``s, and closed ``details``
but for their summary; styles stand in the element or in ``style`` elements, whose rules count if each of
their selectors is one compound of a tag, classes and an id, outside of at-rules; of ``svg`` and ``math`` the parts that only describe or define go, and a
``select`` that is no list shows its chosen option; ``visibility:hidden`` hides text down to a descendant that is visible. A quote opens an attribute's value only after its ``=``. Paragraphs, headings, lists and tables are set off by an empty line, other blocks
start a line, list items have their marker (numbers as ``start``, ``value``, ``reversed`` and ``type`` say)
and indentation, ``pre`` keeps its spaces, and inputs show their value, else their placeholder.

The cells of a table stand in a grid with their column and row spans, padded to the width of their column. A
cell of more than ``WIDE`` characters does not widen its column (it pushes what follows in its row), and row spans hold
within the first 1,000 columns, so a laid-out table takes at most about 100 KB more a row than its text.

Both passes keep their own stack, so nesting of any depth is fine; a page's memory is its tree.

Cases: a null or empty page gives an empty text; repeated rows each get a row; unclosed tags,
comments and attributes end at the end of the page; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas datalist rp".split()
)
#: Not painted within the element of that name.
UNSEEN_IN = {
    "svg": frozenset("title desc defs style script metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
#: Their parts stand above, below or beside each other.
FORMULA = frozenset("mfrac msub msup msubsup munder mover munderover mroot mmultiscripts mtd".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tr ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir pre blockquote table figure hr".split())
CLOSES_P = BLOCK - {"html", "body", "dd", "dt", "li", "legend", "optgroup", "option", "tr"}
#: Opening the tag closes an open element of these kinds, unless a barrier is nearer.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
P_BARRIER = {"table", "td", "th", "caption", "button", "object"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_IMPORTANT = re.compile(r"!\s*important\Z")
_RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
_COMPOUND = re.compile(r"([A-Za-z][A-Za-z0-9]*|\*)?((?:[.#][A-Za-z0-9_\x80-\U0010ffff-]+)*)")
_NAME = re.compile(r"([.#])([^.#]+)")
_INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})(?![0-9])")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_LINES = re.compile(r" *\n *")
#: Longest cell that widens its column, and most columns that row spans reserve.
WIDE, COLUMNS = 100, 1000
#: Inputs that show no text of their own.
SILENT = frozenset("hidden checkbox radio file image range color password".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []  # children: nodes and texts


class _Stack(list):
    """Open elements, with a count of each kind."""

    def __init__(self, root: Node) -> None:
        super().__init__([root])
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.append(node)
        self.open[node.tag] += 1

    def cut(self, at: int) -> None:
        self.open.subtract(n.tag for n in self[at:])
        del self[at:]

    def close(self, kinds: set[str], barrier: set[str]) -> None:
        """Close up to the outermost element of ``kinds`` above the nearest barrier."""
        keep, left = None, sum(self.open[k] for k in kinds)
        for i in range(len(self) - 1, 0, -1):
            if not left or self[i].tag in barrier:
                break
            if self[i].tag in kinds:
                keep, left = i, left - 1
        if keep is not None:
            self.cut(keep)


def tree(page: str) -> tuple[Node, Sheet]:
    """The element tree under one root, and the rules of its style elements."""
    root, sheet = Node("#root", {}), Sheet()
    stack, at, end = _Stack(root), 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not stack.open["p"]:
                stack[-1].children.append(Node("p", {}))
            elif stack.open[tag]:
                barrier = set() if tag in ("table", "html", "body") else {"table"}
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        stack.cut(i)
                        break
                    if stack[i].tag in barrier:
                        break
            continue
        if tag in IMPLIED:
            stack.close(*IMPLIED[tag])
        if tag in CLOSES_P:
            stack.close({"p"}, P_BARRIER)
        attrs = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at)
            text = page[at : close.start()]
            node.children.append(html.unescape(text).removeprefix("\n") if tag == "textarea" else text)
            if tag == "style" and not stack.open["template"] and attrs.get("media", "all").strip().lower() in ("", "all", "screen"):
                sheet.add(text)
            at = close.end()
        elif tag not in VOID and not (m[3].endswith("/") and (stack.open["svg"] or stack.open["math"])):
            stack.push(node)
    return root, sheet


def declared(style: str) -> dict[str, tuple[bool, str]]:
    """Properties of a style, whether they are important, and their values in lower case: the last one wins, but for important ones."""
    out: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub(" ", style).split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        plain = _IMPORTANT.sub("", value).rstrip()
        if plain and (plain != value or not out.get(name, (False,))[0]):
            out[name] = (plain != value, plain)
    return out


class Sheet:
    """The rules of a page's style elements that show or hide, by one of the names in their selector."""

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple]] = {}
        self.size = 0

    def add(self, css: str) -> None:
        for selectors, body in _RULE.findall(_flat(_COMMENT.sub(" ", css))):
            style = {k: v for k, v in declared(body).items() if k in ("display", "visibility")}
            for selector in selectors.split(",") if style else ():
                m = _COMPOUND.fullmatch(selector.strip())
                if not m or not m[0]:
                    continue
                names = _NAME.findall(m[2])
                ids, classes = ({n for kind, n in names if kind == k} for k in "#.")
                tag = "" if m[1] in (None, "*") else m[1].lower()
                key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag or "*"
                self.size += 1
                weight = (sum(k == "#" for k, _ in names), sum(k == "." for k, _ in names), tag != "", self.size)
                self.rules.setdefault(key, []).append((weight, tag, ids, classes, style))

    def style(self, node: Node) -> dict[str, str]:
        """What the rules and the element's own style say."""
        own = declared(node.attrs["style"]) if "style" in node.attrs else {}
        if not self.rules:
            return {k: v for k, (_, v) in own.items()}
        classes, name = set(node.attrs.get("class", "").split()), node.attrs.get("id", "")
        keys = ["*", node.tag, f"#{name}", *(f".{c}" for c in classes)]
        hits = [r for k in keys for r in self.rules.get(k, ()) if r[1] in ("", node.tag) and r[2] <= {name} and r[3] <= classes]
        ranked = [((important, False, weight), k, v) for weight, _, _, _, style in hits for k, (important, v) in style.items()]
        ranked += [((important, True, ()), k, v) for k, (important, v) in own.items()]
        return {k: v for _, k, v in sorted(ranked, key=lambda r: r[0])}


def _flat(css: str) -> str:
    """The sheet without at-rules and their blocks."""
    out, depth, skip = [], 0, False
    for part in re.split(r"([{};])", css):
        if depth == 0 and not skip and part.lstrip().removeprefix("<!--").lstrip().startswith("@"):
            skip = True
        if not skip:
            out.append(part)
        depth = max(depth + (part == "{") - (part == "}"), 0)
        if skip and depth == 0 and part in ("}", ";"):
            skip = False
    return "".join(out)


def hidden(node: Node, style: dict[str, str]) -> bool:
    """Whether the element goes with all that it holds."""
    if node.tag in UNSEEN or "hidden" in node.attrs or (node.tag == "dialog" and "open" not in node.attrs):
        return True
    return style.get("display") == "none"


def painted(style: dict[str, str], inherited: bool) -> bool:
    """Whether the element's own text is painted; visibility is inherited."""
    value = style.get("visibility", "inherit")
    return value not in ("hidden", "collapse") if value in ("visible", "initial", "hidden", "collapse") else inherited


class Writer:
    """Lines of text with collapsed spaces, requested line breaks and a list indentation."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.breaks, self.space, self.empty, self.marker = 0, False, True, ""
        self.indent: list[str] = []

    def text(self, s: str, keep: bool = False) -> None:
        if keep:
            for i, line in enumerate(s.split("\n")):
                if i:
                    self.newline()
                if line:
                    self._put(line)
            return
        if not s:
            return
        words = _BLANK.sub(" ", s)
        body = words.strip(" ")
        if not body:
            self.space = True
            return
        if words[0] == " ":
            self.space = True
        self._put(body)
        self.space = words[-1] == " "

    def _put(self, s: str) -> None:
        if self.breaks or self.empty:
            if not self.empty:
                self.out.append("\n" * self.breaks)
            pad = "".join(self.indent)
            self.out.append(pad[: len(pad) - len(self.marker)] + self.marker if self.marker else pad)
            self.marker = ""
        elif self.space:
            self.out.append(" ")
        self.out.append(s)
        self.breaks, self.space, self.empty = 0, False, False

    def newline(self) -> None:
        self.breaks, self.space = self.breaks + 1, False

    def block(self, n: int) -> None:
        self.breaks, self.space = max(self.breaks, n), False

    def value(self) -> str:
        return "".join(self.out)


def _layout(rows: list[list[tuple[str, int, int]] | None]) -> list[str]:
    """Rows of (text, columns, rows spanned) as lines with aligned cells; a None ends a group of rows, and its spans."""
    placed: list[list[tuple[int, str]]] = []
    width: dict[int, int] = {}
    until: dict[int, float] = {}  # column -> first row without the cell above
    for row in rows:
        if row is None:
            until.clear()
            continue
        col, cells = 0, []
        for s, span, down in row:
            while until.get(col, 0) > len(placed):
                col += 1
            if span == 1 and len(s) <= WIDE:
                width[col] = max(width.get(col, 0), len(s))
            cells.append((col, s))
            if down != 1:
                until.update(dict.fromkeys(range(col, min(col + span, COLUMNS)), len(placed) + (down or math.inf)))
            col += span
        placed.append(cells)
    start, at = {}, 0
    for col in sorted({col for cells in placed for col, _ in cells}):  # columns where no cell starts take no room
        start[col] = at
        at += width.get(col, 0) + 2
    lines = []
    for cells in placed:
        parts, size = [], 0
        for col, s in cells:
            if s:
                gap = max(start[col] - size, 2 if size else 0)
                parts += [" " * gap, s]
                size += gap + len(s)
        lines.append("".join(parts).rstrip())
    return lines


def _integer(node: Node, name: str, default: int | None = None) -> int | None:
    m = _INTEGER.match(node.attrs.get(name, ""))
    return int(m[1]) if m else default


def _spans(cell: Node) -> tuple[int, int]:
    """Columns and rows of a cell; 0 rows: all that are left of the group."""
    return min(max(_integer(cell, "colspan", 1), 1), COLUMNS), min(max(_integer(cell, "rowspan", 1), 0), 65534)


def _numbering(node: Node) -> list:
    """Tag, next number, step and form of numbers of a list."""
    back = -1 if node.tag == "ol" and "reversed" in node.attrs else 1
    items = sum(not isinstance(c, str) and c.tag == "li" for c in node.children) if back < 0 else 1
    return [node.tag, _integer(node, "start", items), back, node.attrs.get("type", "1")]


def _ordinal(n: int, form: str) -> str:
    """A number as letters or in Roman digits where these can write it."""
    if form in ("a", "A") and n > 0:
        out = ""
        while n:
            n, digit = divmod(n - 1, 26)
            out = chr(97 + digit) + out
    elif form in ("i", "I") and 0 < n < 4000:
        out = ""
        for one, five, ten, unit in (("m", "", "", 1000), ("c", "d", "m", 100), ("x", "l", "c", 10), ("i", "v", "x", 1)):
            digit, n = divmod(n, unit)
            out += one * digit if digit < 4 else one + five if digit == 4 else five + one * (digit - 5) if digit < 9 else one + ten
    else:
        return str(n)
    return out.upper() if form.isupper() else out


def _input(node: Node) -> str:
    """What an input shows."""
    kind = node.attrs.get("type", "text").strip().lower()
    if kind in SILENT:
        return ""
    if kind in ("submit", "reset", "button"):
        return node.attrs.get("value", "" if kind == "button" else kind.title())
    return node.attrs.get("value") or node.attrs.get("placeholder", "")


def _chosen(select: Node) -> list:
    """What a select shows: its options if it is a list, else the text of the chosen one."""
    size = select.attrs.get("size", "").strip()
    if "multiple" in select.attrs or (size.isascii() and size.isdigit() and size.strip("0") not in ("", "1")):
        return [c for c in select.children if not isinstance(c, str)]
    options, todo = [], [(c, False) for c in reversed(select.children)]
    while todo:
        node, off = todo.pop()
        if isinstance(node, str):
            continue
        off = off or "disabled" in node.attrs
        if node.tag == "option":
            options.append((node, off))
        elif node.tag not in UNSEEN:
            todo.extend((c, off) for c in reversed(node.children))
    chosen = [o for o, _ in options if "selected" in o.attrs][-1:] or [o for o, off in options if not off][:1]
    return [c for o in chosen for c in _label(o)]


def _label(node: Node) -> list:
    label = node.attrs.get("label", "")
    return [label] if label and node.tag == "option" else [label, *node.children] if label else node.children


def render(root: Node, sheet: Sheet) -> str:
    """The visible text of the tree."""
    writers, tables, lists, pre = [Writer()], [], [], 0
    foreign = {"svg": 0, "math": 0}
    todo: list[tuple] = [(root, False, True)]
    while todo:
        node, leaving, seen = todo.pop()
        w = writers[-1]
        if isinstance(node, str):
            if seen:
                w.text(node, keep=pre > 0)
            continue
        tag = node.tag
        gap = 2 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists) else 1
        if not leaving:
            style = sheet.style(node)
            if hidden(node, style):
                continue
            if any(n and tag in UNSEEN_IN[k] for k, n in foreign.items()):
                continue
            seen = painted(style, seen)
            if tag == "br":
                w.newline()
                continue
            if tag == "input":
                if seen:
                    w.text(f" {_input(node)} ")
                continue
            todo.append((node, True, seen))
            if tag in ("td", "th") and tables:
                writers.append(Writer())
            elif tag == "table":
                w.block(gap)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1].append(None)
            elif tag in BLOCK:
                w.block(gap)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append(_numbering(node))
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    n = _integer(node, "value", lists[-1][1])
                    lists[-1][1] = n + lists[-1][2]
                    mark = f"{_ordinal(n, node.attrs.get('type', lists[-1][3]))}. "
                w.indent.append(" " * len(mark))
                w.marker = mark if seen else ""
            elif tag in ("dd", "blockquote"):
                w.indent.append("  ")
            elif tag in ("pre", "textarea"):
                pre += 1
            elif tag in foreign:
                foreign[tag] += 1
            elif tag == "text" and foreign["svg"]:
                w.block(1)
            shown = node.children
            if tag == "select":
                shown = _chosen(node)
            elif tag in ("option", "optgroup"):
                shown = _label(node)
            elif tag in FORMULA and foreign["math"]:
                shown = [x for c in shown for x in (" ", c)] + [" "]
            if tag == "details" and "open" not in node.attrs:
                shown = [c for c in shown if not isinstance(c, str) and c.tag == "summary"]
            todo.extend((c, False, seen) for c in reversed(shown))
            continue
        if tag in ("td", "th") and tables:
            writers.pop()
            if not tables[-1] or tables[-1][-1] is None:
                tables[-1].append([])
            tables[-1][-1].append((_LINES.sub(" ", w.value()), *_spans(node)))
            continue
        if tag in ("thead", "tbody", "tfoot") and tables:
            tables[-1].append(None)
        if tag == "table":
            for line in _layout(tables.pop()):
                if line:
                    w.text(line, keep=True)
                    w.block(1)
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            w.indent.pop()
            w.marker = ""
        elif tag in ("dd", "blockquote"):
            w.indent.pop()
        elif tag in ("pre", "textarea"):
            pre -= 1
        elif tag in foreign:
            foreign[tag] -= 1
        elif tag == "text" and foreign["svg"]:
            w.block(1)
        if tag in BLOCK:
            w.block(gap)
    return writers[0].value()


def page_text(page: str | None) -> str:
    return render(*tree(page)) if page else ""


def html_text(pages: DataFrame) -> DataFrame:
    """``pages`` (with html) and its visible text in a column ``text`` (an older one is replaced)."""
    own = [c for c in pages.columns if c != "text"]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in own)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(p) for p in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*own, "text"])

    return pages.select(*(F.col(f"`{c}`") for c in own)).mapInArrow(extract, f"{schema}, text string")
