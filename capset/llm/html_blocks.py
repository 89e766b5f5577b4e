"""Blocks of a web page: leaf texts in page order, with the path of open elements above each."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from html import unescape

_TOKENS = [re.compile(
    r"<!--(?:.*?--\s*>|.*)|" + cdata + r"<[!?][^>]*>|"
    # a quote opens a value only straight after =, any other is a character like others
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>|[^<]+|<", re.S) for cdata in ("", r"<!\[CDATA\[.*?\]\]>|")]
_VALUE = re.compile(r"=\s*\"[^\"]*\"|=\s*'[^']*'")
_TAG = re.compile(r"</?[a-zA-Z]")
_NAME = re.compile(r"[^\s/>]*")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?", re.S)
_PART = re.compile(r"[a-z]+", re.I)
#: Elements whose content is not text of the page.
RAW = frozenset("script style template noscript textarea title iframe svg select option datalist xmp noembed noframes".split())
#: Of these, those that HTML reads as raw text: without an end tag they go on to the end of the page.
RAW_TEXT = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img input math mi mn mo ms mrow msup msub mfrac msqrt mtext".split())
#: An opening element of the first kind ends an open one of the second, up to the boundary.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
_KEPT = ("class", "id", "role", "itemprop", "aria-label", "hidden", "style")
_DEPTH = 12  # of the elements above a block, the innermost that its path holds


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # an element each: name and the words of its attributes, outermost first
    linked: float  # share of the characters inside links


def _named(tag: str, attributes: str) -> str:
    """An element's name with the words of its class, id, role and the like."""
    if not attributes.strip(" /\n\t"):
        return tag
    words = []
    for name, a, b, c in _ATTR.findall(attributes):
        name = name.lower()
        if name in _KEPT:
            value = unescape(a or b or c)
            if name == "style":
                if "none" in value and "display" in value:
                    words.append("hidden")
            elif name == "hidden":
                words.append("hidden")
            else:
                # camelCase and other joints part words
                words += [w.lower() for w in _PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))[:12]]
    return " ".join([tag, *words])


class _Endless:
    """Where a tag that begins can have no end, so that no place of a page is looked through again and again for it.

    A tag that was read to the end of the page without one passed each place inside a quoted value or outside of them.  What
    begins at a place that it passed outside fares no better; of ways that differ in this at a place there are but three."""

    def __init__(self, source: str):
        self.source, self.last, self.ways, self.name = source, source.rfind(">"), [], (0, 0)

    def _behind_name(self, i: int) -> int:
        """Where the name of a tag that begins at ``i`` ends; names of tags that begin inside it end there, too."""
        if not self.name[0] <= i < self.name[1] - 1:
            self.name = (i, _NAME.match(self.source, i + 2).end())
        return self.name[1]

    def at(self, i: int) -> bool:
        if i > self.last:
            return not self.source.startswith("<!--", i)
        if not self.ways or self.source[i + 1] in "!?":
            return False
        e = self._behind_name(i)
        if self.source[e:e + 1] == ">":
            return False
        for begin, starts, ends in self.ways:
            k = bisect_right(starts, e) - 1
            if e >= begin and (k < 0 or e >= ends[k] or e == starts[k]):
                return True
        return False

    def note(self, i: int) -> None:
        """No end was found for what begins at ``i``; a ``<`` without a name behind it says nothing."""
        if not _TAG.match(self.source, i):
            return
        e = self._behind_name(i)
        spans = [m.span() for m in _VALUE.finditer(self.source, e)]
        self.ways.append((e, [a for a, _ in spans], [b for _, b in spans]))


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks with text.  Comments, scripts, styles, titles and the like are no text.

    Inline elements don't end a block, all others and ``br`` do.  Character references are decoded, white
    space runs become one blank, ends are trimmed, empty blocks go.  Unclosed elements stay open to the
    end of what holds them; end tags without a beginning are ignored.
    """
    out: list[Block] = []
    tags: list[str] = []  # open elements
    names: list[str] = []
    parts: list[str] = []
    linked = [0]
    links = 0  # open a elements
    at: list[tuple[str, ...]] = [()]

    def flush() -> None:
        if parts:
            raw = "".join(parts)
            text = " ".join(unescape(raw).split() if "&" in raw else raw.split())
            if text:
                out.append(Block(text, at[0], min(1.0, linked[0] / max(1, len(raw)))))
            parts.clear()
        linked[0] = 0

    def close(k: int) -> None:
        nonlocal links
        for t in tags[k:]:
            links -= t == "a"
        del tags[k:], names[k:]

    endless: set[str] = set()  # elements without an end tag from here on
    source = html or ""
    i, n = 0, len(source)
    nowhere, sections = _Endless(source), source.rfind("]]>")
    while i < n:
        begins = source[i] == "<"
        if begins and nowhere.at(i):
            m = tag = None
            i += 1
        else:
            m = _TOKENS[i <= sections].match(source, i)
            begin, i = i, m.end()
            tag = m.group(2)
            if begins and m.group() == "<":
                nowhere.note(begin)
        if tag is None:
            piece = m.group() if m else "<"
            if piece[0] != "<" or piece == "<":
                if not parts:
                    at[0] = tuple(names[-_DEPTH:])
                parts.append(piece)
                if links:
                    linked[0] += len(piece)
            elif piece.startswith("<![CDATA["):
                parts.append(piece[9:-3].replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if m.group(1):
            if tag not in INLINE:
                flush()
            for k in range(len(tags) - 1, -1, -1):
                if tags[k] == tag:
                    close(k)
                    break
                if tag in INLINE and tags[k] not in INLINE:  # an inline end tag ends nothing around its block
                    break
            continue
        if tag in RAW:
            flush_here = tag not in INLINE
            if flush_here:
                flush()
            end = None if tag in endless or i > nowhere.last else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, i)
            if end is None:
                endless.add(tag)
            if not m.group(3).endswith("/") or tag != "svg":
                i = end.end() if end else n if tag in RAW_TEXT else i
            continue
        if tag not in INLINE:
            flush()
            if tag in _ENDS:
                ends, stop = _ENDS[tag]
                for k in range(len(tags) - 1, -1, -1):
                    if tags[k] in stop:
                        break
                    if tags[k] in ends:
                        close(k)
                        break
            else:
                for k in range(len(tags) - 1, -1, -1):  # a block ends an open paragraph
                    if tags[k] == "p":
                        close(k)
                        break
                    if tags[k] not in INLINE:
                        break
        if tag not in VOID and not m.group(3).endswith("/"):
            tags.append(tag)
            names.append(_named(tag, m.group(3)))
            links += tag == "a"
    flush()
    return out
