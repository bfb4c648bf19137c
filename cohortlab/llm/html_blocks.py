"""Web pages to blocks of text, by one pass over their tags.

A block is the text between two block-level tags. Tags may be unclosed or
stray: a new paragraph, item, row or cell closes an open one of its kind, and an
end tag closes what was opened within its element. Scripts, styles, comments
and the like are no text. Those of ``UNSHOWN`` are skipped up to their end tag;
one without it only up to the next block-level tag, so the rest of the page
stays. Character references are decoded and white space
becomes single spaces.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?=[\s/>])([^>]*)>"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|([^<]+|<)", re.S | re.I)
#: what ends the raw text of these elements; within svg, its end does as well
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("script", "style", "textarea", "title")}
SVG_END = re.compile(r"</svg(?=[\s/>])", re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn del em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
#: an opening tag closes an open tag of this set, unless one of the second stands between
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
UNSHOWN = frozenset("noscript template svg iframe object select button head".split())
#: a second one ends an open one
ALONE = frozenset("noscript iframe select button head".split())
#: no end tag of an element around ends one
SCOPED = frozenset("noscript template iframe object foreignobject desc".split())
#: ends an open svg or head, and any skipped element without an end tag
LEVEL = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
FOREIGN = frozenset("annotation-xml color-profile font-face font-face-format font-face-name font-face-src "
                    "font-face-uri missing-glyph".split())
PATH_ENDS = (4, 12)  # the outermost and innermost elements that describe a block


def labels(name: str, attributes: str) -> tuple[str, ...]:
    """The element's tag (not of inline elements, which say little about a
    block), and the words of its class, id and role."""
    out = [] if name in INLINE else [f"<{name}>"]
    for m in ATTRIBUTE.finditer(attributes):
        out += NAME.findall(CAMEL.sub(" ", m[2] or m[3] or m[4] or "").lower())
    return tuple(out)


def is_level(name: str) -> bool:
    """Block-level elements of the body, and custom ones."""
    return name in LEVEL or ("-" in name and name not in FOREIGN)


def tokens(page: str) -> list[tuple[str | None, bool, str | None, str]]:
    """(text, whether an end tag, name of a tag, its attributes) in page order."""
    out, at, svg = [], 0, 0
    while m := TOKEN.match(page, at):
        at = m.end()
        if m[6] is not None:
            out.append((m[6], False, None, ""))
        elif m[4] is not None:
            name, end = m[4].lower(), bool(m[3])
            if name == "svg" and not m[5].endswith("/"):
                svg = max(0, svg - 1) if end else svg + 1
            elif is_level(name):
                svg = 0
            out.append((None, end, name, m[5]))
        elif m[1]:
            if not (svg and m[2].endswith("/")):
                outer = SVG_END.search(page, at) if svg else None
                most = outer.start() if outer else len(page)
                own = RAW_ENDS[m[1].lower()].search(page, at, most)
                at = own.end() if own else most
            out.append((" ", False, None, ""))
    return out


def unshown(found: list[tuple[str | None, bool, str | None, str]]) -> dict[int, int]:
    """Where a skipped element begins, to the first token after it."""
    out: dict[int, int] = {}
    stack: list[list] = []      # name, token, whether skipped, first token that ends it if it has no end tag
    open_: dict[str, int] = {}
    bounds: list[int] = []      # places in the stack of skipped and scoped elements
    undecided: list[list] = []  # skipped elements without such a token

    def close(to: int, at: int) -> None:
        while len(stack) > to:
            name, start, skipped, first = stack.pop()
            open_[name] -= 1
            if bounds and bounds[-1] == len(stack):
                bounds.pop()
            if skipped:
                out[start] = start + 1 if name == "head" else at if first is None else first

    def decide(at: int) -> None:
        for e in undecided:
            e[3] = at
        undecided.clear()

    def last(name: str) -> int:
        return next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)

    for at, (_, end, name, attributes) in enumerate(found):
        if name is None:
            continue
        level = is_level(name)
        if level or name == "br":
            decide(at)
        if level and not end:
            while bounds and stack[bounds[-1]][0] in ("svg", "head"):
                close(bounds[-1], at)
        if end:
            if not open_.get(name):
                continue
            k = len(stack) - 1
            while stack[k][0] != name and not (stack[k][0] in SCOPED or (stack[k][2] and name in INLINE)):
                k -= 1
            if stack[k][0] != name:
                decide(at)
                continue
            close(k + 1, at)
            start, skipped = stack[k][1:3]
            close(k, at)
            if skipped:
                out[start] = at + 1
            continue
        skipped = name in UNSHOWN and (not attributes or attributes[0] in " \t\n\r\f/")
        if name in VOID or attributes.endswith("/"):
            if skipped:
                out[at] = at + 1
            continue
        if name in ALONE and open_.get(name):
            close(last(name), at)
        element = [name, at, skipped, None]
        if skipped or name in SCOPED:
            bounds.append(len(stack))
        if skipped:
            undecided.append(element)
        stack.append(element)
        open_[name] = open_.get(name, 0) + 1
    close(0, len(found))
    return out


def blocks(page: str) -> Iterator[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """(labels of the enclosing elements, text, characters within links)."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_: dict[str, int] = {}
    held: list[str] = []
    linked = 0
    path: tuple[tuple[str, ...], ...] = ()

    def close(to: int) -> None:
        while len(stack) > to:
            open_[stack.pop()[0]] -= 1

    def flush():
        nonlocal held, linked
        text = " ".join(html.unescape("".join(held)).split())
        row = (path, text, linked)
        held, linked = [], 0
        return row if text else None

    found = tokens(page)
    skips = unshown(found)
    until = 0
    for k, (plain, end, name, attributes) in enumerate(found):
        if k < until:
            continue
        if k in skips:
            held.append(" ")
            until = skips[k]
            continue
        if plain is not None:
            if not held or not path:
                whole = [s[1] for s in stack if s[1]]
                first, last = PATH_ENDS
                path = tuple(whole if len(whole) <= first + last else whole[:first] + whole[-last:])
            held.append(plain)
            if open_.get("a"):
                linked += len(plain)
            continue
        block = name not in INLINE
        if block and held:
            if name == "br":
                held.append(" ")
            elif row := flush():
                yield row
        if end:
            if open_.get(name):
                at = len(stack) - 1
                while stack[at][0] != name:
                    at -= 1
                close(at)
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if block and open_.get("p"):  # any block-level tag ends a paragraph
            at = len(stack) - 1
            while stack[at][0] != "p":
                at -= 1
            close(at)
        ends, within = CLOSES.get(name, ((), ()))
        if any(open_.get(x) for x in ends):
            at = len(stack) - 1
            while at >= 0 and stack[at][0] not in ends and stack[at][0] not in within:
                at -= 1
            if at >= 0 and stack[at][0] in ends:
                close(at)
        stack.append((name, labels(name, attributes)))
        open_[name] = open_.get(name, 0) + 1
    if row := flush():
        yield row
