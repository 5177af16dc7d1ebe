"""Cut web pages into blocks: text, tag path and link share of every leaf sequence, in page order."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

#: Elements whose content is never text of the page.
_SKIPPED = "script|style|title|noscript|template|iframe|svg|textarea|select|object|canvas"
#: Of these, the ones whose content runs to the end of the page without an end tag.
_OPEN_ENDED = frozenset("script style textarea title".split())
_END = {
    name: re.compile(rf"</{name}(?=[\t\n\f\r />]|\Z)[^>]*+(?:>|\Z)", re.I) for name in _SKIPPED.split("|")
}
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<skip>{_SKIPPED})(?=[\t\n\f\r />])(?P<own>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^\W\d_]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the value is ended by the start of the key's element.
ENDS = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    depth: int
    link_chars: int


class PathCodes(dict):
    """Hashed codes of a start tag: its name, and the words of its class, id and role."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, key: tuple[str, str]) -> tuple[int, ...]:
        tag, attrs = key
        names = {tag}
        for found in _NAMED.finditer(attrs):
            value = (found[1] or found[2] or found[3] or "").lower()
            names.update("." + w for w in value.split())
            names.update("." + w for w in _PARTS.findall(value))
        codes = tuple(sorted({zlib.crc32(n.encode()) % self.size for n in names}))
        if len(self) > 50_000:
            self.clear()
        self[key] = codes
        return codes


def blocks_of(page: str, codes: PathCodes) -> list[Block]:
    """Blocks with text. Inline elements and line breaks do not end a block; every other tag does.

    Character references are decoded, white space becomes single spaces. Unclosed and stray tags are
    allowed: a start tag ends an open paragraph or list item as browsers do, an end tag closes what
    was opened inside it. Elements whose content is no text are left out up to their end tag; a
    self-closed svg is empty, and without an end tag only scripts, styles, titles and text areas run to
    the end of the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    parts: list[str] = []
    held: list[tuple[str, tuple[int, ...]]] = []
    links = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = tuple(c for _, own in held for c in own)
            out.append(Block(text, path, len(held), min(link_chars, len(text))))
        parts.clear()
        link_chars = 0

    def add(piece: str) -> None:
        nonlocal link_chars, held
        if piece:
            if not piece.isspace():
                if not any(p and not p.isspace() for p in parts):
                    held = [e for e in stack if e[0] not in INLINE or e[0] in ("a", "label")]
                if links:
                    link_chars += len(piece)
            parts.append(piece)

    def skipped(name: str, start: int) -> int:
        """Where the content of a skipped element ends that starts there."""
        end = None if name in unended else _END[name].search(page, start)
        if end:
            return end.end()
        unended.add(name)
        return len(page) if name in _OPEN_ENDED else start

    at = 0
    unended: set[str] = set()
    while found := _TOKEN.search(page, at):
        add(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            if name := (found["skip"] or "").lower():
                if name != "svg" or not found["own"].endswith("/"):
                    at = skipped(name, at)
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if found["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    links -= sum(e[0] == "a" for e in stack[k:])
                    del stack[k:]
                    break
            continue
        if tag not in INLINE and stack:
            opened = [e[0] for e in stack]
            end = "p" if "p" in opened else None
            if tag in ENDS and tag in opened and not {"ul", "ol", "table", "dl"} & {*opened[len(opened) - opened[::-1].index(tag) :]}:
                end = tag
            if end:
                k = len(opened) - 1 - opened[::-1].index(end)
                links -= opened[k:].count("a")
                del stack[k:]
        if tag not in VOID and not found["attrs"].endswith("/"):
            stack.append((tag, codes[tag, found["attrs"]]))
            links += tag == "a"
    add(page[at:])
    flush()
    return out
