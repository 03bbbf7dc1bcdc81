"""Leaf blocks of a page: texts between block-level tags, with the features of where they stand and what they say.

The scan follows tags only as far as blocks need: it keeps the open block-level
elements, closes paragraphs, items and cells where the next one starts, and
leaves out elements that hold no text for readers. It is linear in the page,
takes any text (unclosed, truncated, stray tags) and fails on none.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import xxhash

from crystalflow.llm.page_words import CUES, ROLES

SLOTS = 1 << 16
SHORT = 15  # blocks of at most so many words have cue words as features
CACHED = 100_000  # ancestor lists and words remembered per task

# --- fixed values: elements of HTML by role --------------------------------
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul hr head optgroup option".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())  # hold text up to their own end tag
SILENT = frozenset("script style textarea title iframe noembed noframes noscript template svg math select datalist button object canvas audio video".split())
# a start tag closes the open element of the second set, unless one of the third set is nearer
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
NESTS_PARAGRAPHS = frozenset("td th li dd button object caption".split())  # a paragraph outside stays open

# a quote opens a value only after an equals sign
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    around: frozenset[str]  # features of the open elements
    parent: int  # number of the element that holds it
    linked: int  # characters in links


class _Node:
    __slots__ = ("tag", "around", "number", "silent")

    def __init__(self, tag: str, around: frozenset[str], number: int, silent: bool):
        self.tag, self.around, self.number, self.silent = tag, around, number, silent


_around: dict[tuple, frozenset[str]] = {}


def _inside(around: frozenset[str], outer: str, tag: str, attributes: str) -> frozenset[str]:
    """The features of ``around`` and those of one more element within an ``outer`` one."""
    key = around, outer, tag, attributes
    found = _around.get(key)
    if found is None:
        if len(_around) >= CACHED:
            _around.clear()
        names = {f"in {tag}", f"{tag} in {outer}"}
        for kind, *values in _ATTRIBUTE.findall(attributes):
            for part in _PART.findall(next((v for v in values if v), "")):
                word = part.lower()
                names.add(f"{'role' if kind.lower() == 'role' else 'name'} {word}")
                if word in ROLES:
                    names.add(f"part {ROLES[word]}")
        found = _around[key] = around | names
    return found


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks of a page in page order; none for null."""
    page = page or ""
    out: list[Block] = []
    stack = [_Node("", frozenset(), 0, False)]
    pieces: list[str] = []
    opened: Counter[str] = Counter()  # open elements by tag, so that no search of the stack is in vain
    linked = in_link = number = at = 0

    def flush() -> None:
        nonlocal linked, in_link
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, stack[-1].around, stack[-1].number, min(linked, len(text))))
            pieces.clear()
        linked = in_link = 0

    def cut(k: int) -> None:
        opened.subtract(node.tag for node in stack[k:])
        del stack[k:]

    def close(tags: set[str] | frozenset[str], fence: set[str] | frozenset[str]) -> None:
        """Close the open elements of ``tags`` that no element of ``fence`` is above of."""
        while any(opened[t] for t in tags):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in fence:
                    return
                if stack[k].tag in tags:
                    cut(k)
                    break

    size = len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and not stack[-1].silent:
            text = page[at:start]
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked += len(text.strip())
        if start == size:
            break
        follows = page[start + 1 : start + 2]
        if follows == "!" or follows == "?":
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)  # <!--> is a whole comment
                at = size if end < 0 else end + 3
            elif page.startswith("<![CDATA[", start) and (end := page.find("]]>", start)) >= 0:
                at = end + 3
            else:
                end = page.find(">", start)
                at = size if end < 0 else end + 1
            continue
        found = _TAG.match(page, start)
        if found is None:
            if follows.isascii() and (follows.isalpha() or follows == "/") and page.find(">", start) < 0:
                break  # the page ends within a tag
            if follows == "/" and not page[start + 2 : start + 3].isalpha():
                at = page.find(">", start) + 1  # an empty or odd end tag
                continue
            if not stack[-1].silent:
                pieces.append("<")
            at = start + 1
            continue
        at = found.end()
        ends, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if ends:
            if tag == "a":
                in_link = 0
            elif tag == "br":
                pieces.append(" ")
            if tag in BLOCK and not stack[-1].silent:
                flush()
            if opened[tag]:
                cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag == "a":
            in_link = 1
        elif tag == "br":
            pieces.append(" ")
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = size if end is None else end.start()
            if end is not None:
                stop = page.find(">", at)
                at = size if stop < 0 else stop + 1
            continue
        if tag in BLOCK:
            if not stack[-1].silent:
                flush()
            if tag not in ("html", "body", "option", "optgroup"):
                close({"p"}, NESTS_PARAGRAPHS)
            if tag in CLOSES:
                close(*CLOSES[tag])
        if tag in VOID or (tag not in BLOCK and tag not in SILENT):
            continue
        number += 1
        silent = stack[-1].silent or tag in SILENT
        opened[tag] += 1
        stack.append(_Node(tag, _inside(stack[-1].around, stack[-1].tag, tag, attributes), number, silent))
    flush()
    return out


_slots: dict[str, int] = {}


def slot(name: str) -> int:
    """A feature's slot."""
    found = _slots.get(name)
    if found is None:
        if len(_slots) >= CACHED:
            _slots.clear()
        found = _slots[name] = xxhash.xxh3_64_intdigest(name.encode()) % SLOTS
    return found


def said(block: Block) -> list[str]:
    """Features of a block's text: length, words, links, how it ends."""
    text, size = block.text, len(block.text)
    words = text.split(" ")
    count = len(words)
    share = block.linked / size
    out = [
        "any",
        f"words {min(count.bit_length(), 8)}",
        f"links {0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.9 else 3}",
        f"end {text[-1] if text[-1] in '.!?:;,' else ''}",
        f"long {count > SHORT} links {share >= 0.5}",
    ]
    if text[0] == "©" or "©" in text[:40]:
        out.append("copyright sign")
    if count <= SHORT:
        out.extend(f"word {w}" for w in CUES.intersection(w.strip(".,:;!?()|").lower() for w in words))
    return out


def step(before: Block, block: Block) -> int:
    """Kind of border between two blocks: 0 in one element, 1 in like elements, 2 between unlike ones."""
    if before.parent == block.parent:
        return 0
    return 1 if before.around == block.around else 2
