"""Operator 5: HTML extraction by layout-aware rendering.

A tokenizer and a tree builder with implied end tags make a tree of each whole
page; visibility rules (elements never shown, hidden and closed ones, inline
styles, and the page's own style sheets: selectors of tags, classes and ids, one
inside the other) prune it; a renderer writes all that is left: blocks on lines of
their own with blank lines between paragraphs, lists with markers and indents,
preformatted text as it stands, and tables with their cells aligned in columns,
spans in both directions included.  Everything is iterative, so depth is no limit.

Nulls: null or empty HTML gives an empty text.  A column `text` of the pages gives
way to the rendered one; all other columns stay; repeated rows give repeated rows.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_batches, lean

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style template noscript iframe object audio video canvas datalist noembed noframes title meta link base param source track rp map area desc metadata defs symbol clippath marker pattern annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl pre blockquote table figure hr fieldset".split())
#: An open element that a start tag ends, up to an element that bars the search.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
}
ENDS_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption legend option optgroup".split())
BARS = frozenset("table td th caption button object template html applet marquee".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Drawing elements whose own text is not shown (that of text elements inside them is).
DRAWN = frozenset("svg g path rect circle ellipse line polygon polyline use image".split())
COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
#: Media that a page on a screen of any width has.
SCREEN = re.compile(r"\s*(?:only\s+)?(?:screen|all)?\s*", re.I)
COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")
#: Inline elements that stay open, for the text, across blocks that hold their end tag.
PHRASES = frozenset("abbr bdi bdo cite data del dfn ins kbd label mark output q samp span sub sup time var".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SPACES = re.compile(r"[ \t\n\r\f]+")


#: Elements in which a slash ends a tag.
DRAWN = ("svg", "math", "path")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "met")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None" = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.met: tuple[int, int] | None = None  # what Selectors has found of it


class Open:
    """The open elements, outermost first, with the places of each tag, so that none has to be looked for.

    An element that ends before those inside it leaves a gap.
    """

    def __init__(self, root: Node):
        self.held: list[Node | None] = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    @property
    def top(self) -> Node:
        return self.held[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.held))
        if node.tag in BLOCK:
            self.blocks.append(len(self.held))
        self.held.append(node)

    def cut(self, k: int) -> None:
        """Ends the element at k and all inside it."""
        for node in reversed(self.held[k:]):
            if node is not None:
                self.places[node.tag].pop()
        del self.held[k:]
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()
        while self.held[-1] is None:
            self.held.pop()

    def drop(self, k: int) -> None:
        """Ends the innermost element of its tag, at k, alone."""
        node = self.held[k]
        self.places[node.tag].pop()
        if node.tag in BLOCK:
            self.blocks.remove(k)
        self.held[k] = None

    def last(self, tags) -> int:
        """The innermost place of any of the tags; -1 if none is open."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)


def tokens(page: str):
    """("text", text) | ("start", tag, attributes as written) | ("end", tag) | ("raw", text of a raw element)."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield ("text", page[at:])
            return
        if lt > at:
            yield ("text", page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        elif m := TAG.match(page, lt):
            tag, at = m[2].lower(), m.end()
            if m[1]:
                yield ("end", tag)
                continue
            yield ("start", tag, m[3])
            if tag in RAW and not m[3].endswith("/"):
                close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                end = close.start() if close else n
                yield ("raw", page[at:end])
                at = end
        elif lt + 1 < n and (page[lt + 1].isalpha() or page[lt + 1] == "/"):  # a tag without its end: browsers drop it
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        else:
            yield ("text", "<")
            at = lt + 1


def tree(page: str) -> tuple[Node, list[str]]:
    """The page's tree and its style sheets."""
    root, sheets = Node("html", {}), []
    stack = Open(root)

    def close(tags, bars):
        k = stack.last(tags)
        if k < 0 or k < stack.last(bars):
            return False
        stack.cut(k)
        return True

    def close_inline(tag):
        """Ends an inline element; a block that began inside it stays open."""
        k = stack.last((tag,))
        block = stack.blocks[-1] if stack.blocks else -1
        if k < 0 or k < stack.last(BARS) or tag not in FORMATTING and k < block:
            return
        if k >= block:
            stack.cut(k)
        elif tag in FORMATTING:
            stack.drop(k)

    for token in tokens(page):
        kind = token[0]
        if kind == "text":
            stack.top.children.append(html.unescape(token[1]) if "&" in token[1] else token[1])
        elif kind == "raw":
            if stack.top.tag == "style":
                if any(SCREEN.fullmatch(x) for x in stack.top.attrs.get("media", "").split(",")):
                    sheets.append(token[1])
            elif stack.top.tag == "textarea":
                stack.top.children.append(html.unescape(token[1]))
            else:
                stack.top.children.append(token[1])
        elif kind == "end":
            tag = token[1]
            if tag == "p" and stack.last(("p",)) < 0:
                stack.top.children.append(Node("p", {}))
            elif tag == "br":
                stack.top.children.append(Node("br", {}))
            elif tag in FORMATTING or tag in PHRASES:
                close_inline(tag)
            else:
                close((tag,), () if tag in ("table", "body", "html") else BARS - {tag})
        else:
            _, tag, written = token
            attrs = {}
            if "=" in written or written.strip():
                for m in ATTRIBUTE.finditer(written):
                    value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
                    attrs.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
            if tag == "html":
                root.attrs = attrs | root.attrs
                continue
            if tag in ENDS_P:
                close(("p",), BARS)
            if tag in BLOCK or tag in ("body",):
                if stack.top.tag == "head":
                    stack.cut(len(stack.held) - 1)
            if tag in CLOSES:
                tags, bars = CLOSES[tag]
                while close(tags, bars):
                    pass
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and stack.top.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                stack.cut(len(stack.held) - 1)
            node = Node(tag, attrs, stack.top)
            stack.top.children.append(node)
            if tag not in VOID and not (written.endswith("/") and (tag in DRAWN or stack.last(DRAWN) >= 0)):
                stack.push(node)
    return root, sheets


def declared(style: str) -> dict[str, tuple[bool, bool]]:
    """What declarations say of display and visibility: (important, whether it hides); the last one counts unless an earlier one is important."""
    out: dict[str, tuple[bool, bool]] = {}
    for part in style.split(";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if colon and name in ("display", "visibility"):
            value, bang, _ = value.lower().partition("!")
            if bool(bang) >= out.get(name, (False,))[0]:
                out[name] = (bool(bang), value.strip() in (("none",) if name == "display" else ("hidden", "collapse")))
    return out


def rules(sheet: str):
    """(selectors, declarations) that hold on a screen; blocks for print, for widths and the like, and those that are no style rules, are passed over."""
    sheet, at = COMMENT.sub(" ", sheet), 0
    inside: list[bool] = []  # whether the rules of the blocks around hold
    while at < len(sheet):
        brace = min((k for k in (sheet.find("{", at), sheet.find("}", at)) if k >= 0), default=-1)
        if brace < 0:
            return
        if sheet[brace] == "}":
            if inside:
                inside.pop()
            at = brace + 1
            continue
        head = sheet[at:brace].rpartition(";")[2].strip()
        if head.startswith("@"):
            name, _, rest = head[1:].replace("(", " (", 1).partition(" ")
            held = name.lower() == "media" and any(SCREEN.fullmatch(x) for x in rest.split(",")) or name.lower() == "layer"
            inside.append(held and all(inside))
            at = brace + 1
            continue
        end = sheet.find("}", brace)
        end = len(sheet) if end < 0 else end
        if all(inside):
            yield head, sheet[brace + 1 : end]
        at = end + 1


def parsed(selector: str) -> list[tuple[str, frozenset, frozenset, bool]] | None:
    """(tag, classes, ids, whether the next one inwards must be its child) from the innermost outwards; None for what is beyond tags, classes and ids."""
    out, direct = [], False
    for part in reversed(re.sub(r"\s*>\s*", " > ", selector).split()):
        if part == ">":
            direct = True
            continue
        if not (m := COMPOUND.fullmatch(part)):
            return None
        names = re.findall(r"([.#])([\w-]+)", m[2])
        out.append(((m[1] or "*").lower(), frozenset(n for k, n in names if k == "."), frozenset(n for k, n in names if k == "#"), direct))
        direct = False
    return None if direct or not out else out


def hidden_by(sheets: list[str]) -> list[tuple[list, dict]]:
    """(parsed selector, declarations) of the rules that say of display or visibility, weakest first; none if nothing hides."""
    out = []
    for sheet in sheets:
        for selectors, style in rules(sheet):
            if said := declared(style):
                out += [(s, said) for selector in selectors.split(",") if (s := parsed(selector))]
    out.sort(key=lambda r: (sum(len(x[2]) for x in r[0]), sum(len(x[1]) for x in r[0]), sum(x[0] != "*" for x in r[0])))
    return out if any(hides for _, said in out for _, hides in said.values()) else []


def fits(node: Node, compound: tuple) -> bool:
    tag, classes, ids, _ = compound
    return tag in ("*", node.tag) and (not classes or classes <= set(node.attrs.get("class", "").split())) and (not ids or ids <= {node.attrs.get("id")})


class Selectors:
    """Which rules mean a node, whatever its depth: what a node and its ancestors have met is kept as bits.

    Every compound of every selector has a bit, the outermost of a selector first.  A node meets a compound if it fits it and
    its parent (a child is asked for) or any ancestor has met the one before.
    """

    def __init__(self, hiding: list[tuple[list, dict]]):
        self.styles, self.parts, self.first, self.direct, self.last = [], [], 0, 0, []
        self.known: dict[tuple, int] = {}
        for selector, style in hiding:
            for k in range(len(selector) - 1, -1, -1):
                bit = 1 << len(self.parts)
                self.parts.append(selector[k])
                if k == len(selector) - 1:
                    self.first |= bit
                elif selector[k + 1][3]:  # says of the next one outwards that it must be the parent
                    self.direct |= bit
            self.last.append(bit)
            self.styles.append(style)
        self.ends = sum(self.last)

    def _fit(self, node: Node) -> int:
        key = node.tag, node.attrs.get("class"), node.attrs.get("id")
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[key] = sum(1 << k for k, c in enumerate(self.parts) if fits(node, c))
        return self.known[key]

    def met(self, node: Node) -> int:
        chain = []
        at: Node | None = node
        while at is not None and at.met is None:
            chain.append(at)
            at = at.parent
        own, any_ = at.met if at is not None else (0, 0)
        for n in reversed(chain):
            own = self._fit(n) & (self.first | self.direct & own << 1 | ~(self.first | self.direct) & any_ << 1)
            any_ |= own
            n.met = own, any_
        return own

    def meaning(self, node: Node):
        """Declarations of the rules that mean the node, weakest first."""
        hit = self.met(node) & self.ends
        if hit:
            for bit, style in zip(self.last, self.styles, strict=True):
                if hit & bit:
                    yield style


def visible(node: Node, hiding: Selectors | None, parent: Node | None) -> tuple[bool, bool | None]:
    """(whether the node has a box; whether its text is shown, None: as its parent's)."""
    if node.tag in NEVER or node.tag == "input":
        return False, None
    a = node.attrs
    if node.tag == "dialog" and "open" not in a:
        return False, None
    if parent is not None and parent.tag == "details" and "open" not in parent.attrs and node.tag != "summary":
        return False, None
    said: dict[str, tuple[bool, bool]] = {}
    for style in hiding.meaning(node) if hiding else ():
        for what, new in style.items():
            if new[0] >= said.get(what, (False,))[0]:
                said[what] = new
    if "style" in a:
        for what, new in declared(a["style"]).items():
            if new[0] >= said.get(what, (False,))[0]:
                said[what] = new
    if "hidden" in a and "display" not in said:
        return False, None
    return not said.get("display", (False, False))[1], not said["visibility"][1] if "visibility" in said else None


def chosen(node: Node) -> list:
    """What a select shows: all its options if it is a list, else the selected one or the first that can be."""
    size = node.attrs.get("size", "")
    if "multiple" in node.attrs or size.isdecimal() and int(size) > 1:
        return node.children
    options = []
    for x in node.children:
        if isinstance(x, Node):
            options += [x] if x.tag == "option" else [y for y in x.children if isinstance(y, Node) and y.tag == "option"] if x.tag == "optgroup" else []
    own = [x for x in options if "selected" in x.attrs][-1:] or [x for x in options if "disabled" not in x.attrs][:1]
    return [" ", *([own[0].attrs["label"]] if own[0].attrs.get("label") else own[0].children), " "] if own else []


class Lines:
    """Text being laid out: finished lines, the current one, and the blank lines owed before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def text(self, words: str) -> None:
        flat = SPACES.sub(" ", words)
        if flat == " ":
            self.space = True
            return
        if not flat:
            return
        if flat[0] == " ":
            self.space, flat = True, flat[1:]
        tail = flat[-1] == " "
        if tail:
            flat = flat[:-1]
        if not self.parts:
            self.begin()
        elif self.space:
            self.parts.append(" ")
        self.parts.append(flat)
        self.space = tail

    def begin(self) -> None:
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.parts.append(self.marker or self.indent)
        self.marker = ""

    def end(self, gap: int = 0) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []
        self.space = False
        self.gap = max(self.gap, gap)

    def new_line(self) -> None:
        if self.parts:
            self.end()
        elif self.lines:
            self.gap += not self.gap

    def whole(self, lines: list[str]) -> None:
        """Lines that keep their blanks."""
        self.end()
        for x in lines:
            if not self.parts:
                self.begin()
            self.parts.append(x)
            self.end()

    def result(self) -> list[str]:
        self.end()
        return self.lines


def placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, list[str], int]]]:
    """Rows of (first column, cell lines, columns spanned): cells move past the columns that cells of earlier rows still take."""
    out, taken = [], {}  # column: rows that it is taken for yet
    for row in rows:
        c, line, new = 0, [], {}
        for lines, span, down in row:
            while any(taken.get(x, 0) for x in range(c, c + span)):
                c += 1
            line.append((c, lines, span))
            if down > 1:
                new |= dict.fromkeys(range(c, c + span), down - 1)
            c += span
        taken = {x: n - 1 for x, n in taken.items() if n > 1} | new
        out.append(line)
    return out


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (cell lines, columns spanned, rows spanned) with every column as wide as its widest cell; two blanks part columns."""
    width: dict[int, int] = {}
    placings = placed(rows)
    for row in placings:
        for c, lines, span in row:
            if span == 1:
                width[c] = max(width.get(c, 0), max(map(len, lines), default=0))
    left, at = [0], 0
    for c in range(max((c + span for row in placings for c, _, span in row), default=0)):
        at += width.get(c, 0) + 2
        left.append(at)
    out = []
    for row in placings:
        for k in range(max((len(lines) for _, lines, _ in row), default=0)):
            line, shift = "", 0
            for c, lines, span in row:
                line = line.ljust(left[c] + shift)
                cell = lines[k] if k < len(lines) else ""
                line += cell
                over = len(max(lines, key=len, default="")) - (left[c + span] - 2 - left[c])
                shift += max(0, over)  # a cell wider than the columns that it spans pushes the rest of its row
                line = line.ljust(left[c + span] - 2 + shift)
            out.append(line.rstrip(" "))
    return [x for x in out if x]


def render(page: str | None) -> str:
    if not page:
        return ""
    root, sheets = tree(page)
    found = hidden_by(sheets)
    hiding = Selectors(found) if found else None
    out = Lines()
    outer: list = []  # layouts and tables around the current one
    lists: list[list] = []
    pre = 0
    todo: list = [(root, None, True, True)]
    while todo:
        node, parent, opens, shown = todo.pop()
        if isinstance(node, str):
            if parent.tag in DRAWN or not shown:
                continue
            if pre:
                for k, part in enumerate(node.split("\n")):
                    if k:
                        if not out.parts:
                            out.begin()
                        out.end()
                    if part:
                        if not out.parts:
                            out.begin()
                        out.parts.append(part)
            else:
                out.text(node)
            continue
        tag = node.tag
        if opens:
            boxed, own = visible(node, hiding, parent)
            if not boxed:
                continue
            shown = shown if own is None else own
            if tag == "br":
                out.new_line()
                continue
            if tag == "wbr":
                continue
            todo.append((node, parent, False, shown))
            if tag == "table":
                out.end(1)
                outer.append((out, [], lists, pre))
                out, lists, pre = Lines(), [], 0
            elif tag == "tr" and outer:
                out.end()
                outer[-1][1].append([])
            elif tag in ("td", "th") and outer:
                if not outer[-1][1]:
                    outer[-1][1].append([])
                outer[-1][1][-1].append(None)  # its place
                outer.append((out, outer[-1][1], lists, pre))
                out, lists, pre = Lines(), [], 0
            elif tag == "textarea":
                out.end()
                pre += 1
            elif tag == "text":
                out.space = True
            elif tag in BLOCK:
                out.end(1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists) else 0)
                if tag in ("ul", "ol", "menu", "dir"):
                    try:
                        start = int(node.attrs.get("start", 1))
                    except ValueError:
                        start = 1
                    lists.append([tag, start, out.indent])
                elif tag == "li":
                    mark = "- "
                    if lists and lists[-1][0] == "ol":
                        value = node.attrs.get("value", "").strip()
                        lists[-1][1] = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else lists[-1][1]
                        mark = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    base = lists[-1][2] if lists else out.indent
                    out.marker, out.indent = base + mark if shown else "", base + " " * len(mark)
                elif tag in ("blockquote", "dd"):
                    out.indent += "  "
                elif tag == "pre":
                    pre += 1
                elif tag == "hr":
                    out.gap = max(out.gap, 1)
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [x for x in children if isinstance(x, Node)]
            elif tag == "select":
                children = chosen(node)
            elif tag == "optgroup" and node.attrs.get("label"):
                children = [Node("div", {}), *children]
                children[0].children.append(node.attrs["label"])
            elif tag in ("pre", "textarea") and children and isinstance(children[0], str):
                children = [re.sub(r"^\r?\n", "", children[0]), *children[1:]]
            todo += [(x, node, True, shown) for x in reversed(children)]
            continue
        if tag == "table":
            caption = out.result()
            layout, rows, lists, pre = outer.pop()
            out = layout
            lines = caption + aligned([[c for c in row if c] for row in rows])
            if lines:
                out.whole(lines)
            out.end(1)
        elif tag in ("td", "th") and outer and len(outer) > 1 and outer[-1][1] is outer[-2][1]:
            lines = out.result()
            out, rows, lists, pre = outer.pop()
            span, down = (min(int(x), 1000) if x.isdecimal() and int(x) else 1 for x in (node.attrs.get("colspan", "1"), node.attrs.get("rowspan", "1")))
            rows[-1][-1] = (lines, span, down)
        elif tag == "textarea":
            pre = max(pre - 1, 0)
            out.end()
        elif tag == "text":
            out.space = True
        elif tag in BLOCK:
            if tag == "pre":
                pre = max(pre - 1, 0)
            out.end(1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and len(lists) > 1) else 0)
            if tag in ("ul", "ol", "menu", "dir") and lists:
                out.indent = lists.pop()[2]
            elif tag == "li":
                out.marker = ""
                out.indent = lists[-1][2] if lists else ""
            elif tag in ("blockquote", "dd"):
                out.indent = out.indent[:-2]
    return "\n".join(out.result())


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with its HTML replaced by the rendered column text."""
    place = pages.columns.index(html_col)
    rest = [k for k, c in enumerate(pages.columns) if c not in (html_col, "text")]
    plain = pages.toDF(*[f"c{k}" for k in range(len(pages.columns))])  # names may differ in case alone
    kept = plain.select(*[F.col(f"c{k}") for k in rest], F.col(f"c{place}").alias("text"))

    def run(batches):
        for b in doc_batches(batches):
            k = b.schema.get_field_index("text")
            yield b.set_column(k, "text", pa.array([render(x) for x in b.column(k).to_pylist()], pa.string()))

    return kept.mapInArrow(lean(run), kept.schema).toDF(*[pages.columns[k] for k in rest], "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return extract(pages).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))
