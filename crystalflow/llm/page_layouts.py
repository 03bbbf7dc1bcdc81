"""Labelled pages to train extraction on: texts set into random page layouts.

The words come from a bounded sample of the corpus, the layouts from a small
grammar: what surrounds an article on the web (menus, headers, notices,
adverts, side columns, forms, comments, footers), under many element and class
names, tidy and untidy, with and without semantic elements. As the grammar
sets the article's blocks itself, it knows the main text.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.page_words import CONTENT, NAMES, PHRASES
from crystalflow.llm.sampling import lowest_hashes, texts_of

TRAIN_PAGES = 2_400


class Page:
    """One random page around the lines of a text."""

    def __init__(self, lines: list[str], seed: int):
        self.random = random.Random(seed)
        self.lines = [" ".join(x.split()) for x in lines if x.strip()] or ["word"]
        self.words = " ".join(self.lines).split()
        self.gold: list[str] = []
        self.styled = self.random.random() < 0.8  # else elements have no names at all
        self.untidy = self.random.random() < 0.4

    def chance(self, share: float) -> bool:
        return self.random.random() < share

    def pick(self, values):
        return self.random.choice(values)

    def prose(self, least: int, most: int) -> str:
        """Words of the corpus, as a sentence or so."""
        count = self.random.randint(least, most)
        start = self.random.randrange(max(1, len(self.words) - count))
        return " ".join(self.words[start : start + count]) + ("." if self.chance(0.5) else "")

    def named(self, role: str) -> str:
        """Attributes that name a part, or none."""
        if not self.styled or self.chance(0.1):
            return ""
        names = CONTENT if role == "content" else NAMES[role]
        name = self.pick(names)
        if self.chance(0.3):
            name = self.pick([f"{name} {self.pick(['wrap', 'inner', 'col-8', 'clearfix', 'block'])}", f"site-{name}", f"{name}__inner", f"{name}-{self.random.randint(1, 99)}", name.upper(), f"js-{name}"])
        return f' {self.pick(["class", "class", "id"])}="{name}"'

    def end(self, tag: str) -> str:
        return "" if self.untidy and tag in ("p", "li") and self.chance(0.5) else f"</{tag}>"

    def inline(self, text: str) -> str:
        """Escaped text with some inline markup; the text itself stays."""
        words = [html.escape(w, quote=self.chance(0.3)) for w in text.split(" ")]
        if len(words) > 3 and self.chance(0.4):
            k = self.random.randrange(len(words) - 1)
            tag = self.pick(["b", "i", "em", "strong", "span", "a", "code"])
            attributes = ' href="/x"' if tag == "a" else ""
            words[k] = f"<{tag}{attributes}>{words[k]}</{tag}>"
        if len(words) > 5 and self.chance(0.15):
            k = self.random.randrange(1, len(words) - 1)
            words[k] = f"<br>{words[k]}"
        gap = self.pick([" ", " ", "\n", "  "])
        return gap.join(words)

    def kept(self, tag: str, text: str) -> str:
        """A block of the main text."""
        self.gold.append(text)
        return f"<{tag}>{self.inline(text)}{self.end(tag)}"

    def links(self, role: str, most: int = 8) -> str:
        items = [self.pick(PHRASES[role]) if self.chance(0.5) else self.prose(1, 4) for _ in range(self.random.randint(2, most))]
        if self.chance(0.6):
            inside = "".join(f'<li><a href="/{k}">{html.escape(t)}</a>{self.end("li")}' for k, t in enumerate(items))
            return f"<{self.pick(['ul', 'ol'])}>{inside}</ul>"
        return self.pick([" | ", " ", "</div><div>"]).join(f'<a href="/{k}">{html.escape(t)}</a>' for k, t in enumerate(items))

    def part(self, role: str) -> str:
        """A part that is not main text."""
        r = self.random
        tags = {"menu": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"], "side": ["aside", "aside", "div", "section"],
                "notice": ["div", "section", "p", "aside"], "advert": ["div", "div", "aside", "section", "p"], "form": ["form", "div", "section"],
                "comments": ["section", "div", "div"], "share": ["div", "ul", "p"]}
        tag = self.pick(tags[role])
        name = "" if tag in ("nav", "header", "footer", "aside", "form") and self.chance(0.5) else self.named(role)
        if not name and tag in ("div", "section", "p") and role not in ("menu", "share"):
            name = f' class="{self.pick(NAMES[role])}"'  # prose without any sign of its role teaches nothing
        phrase = html.escape(self.pick(PHRASES[role]))
        if role == "menu":
            inside = self.links(role)
        elif role == "header":
            inside = f"<{(h := self.pick(['h1', 'div', 'p', 'h2']))}>{html.escape(self.prose(1, 4))}</{h}>" + (f"<p>{phrase}</p>" if self.chance(0.5) else "") + (f"<nav>{self.links('menu')}</nav>" if self.chance(0.5) else "")
        elif role == "footer":
            inside = phrase + (f"<p>{html.escape(self.prose(2, 14))}</p>" if self.chance(0.5) else f" &middot; {html.escape(self.prose(2, 8))}") + (self.links(role, 5) if self.chance(0.4) else "")
        elif role == "side":
            inside = f"<h3>{phrase}</h3>" + (self.links(role) if self.chance(0.6) else "".join(f"<{(t := self.pick(['p', 'div', 'h4']))}>{html.escape(self.prose(3, 30))}</{t}>" for _ in range(r.randint(1, 4))))
        elif role in ("notice", "advert"):
            text = html.escape(self.prose(3, 40))
            shapes = [phrase, text, f"{phrase} {text}", f"<p>{text}</p>", f"<b>{phrase}</b><p>{text}</p>"]
            inside = self.pick(shapes[:3] if tag == "p" else shapes) + self.pick(["", "", "<button>OK</button>", ' <a href="/more">More</a>'])
        elif role == "form":
            field = f'<label>{phrase}</label><input name="q"><textarea>{html.escape(self.prose(1, 6))}</textarea><button>Send</button>'
            inside = (f"<h3>{phrase}</h3><p>{html.escape(self.prose(3, 15))}</p>" if self.chance(0.5) else "") + (field if tag == "form" else f"<form>{field}</form>")
        elif role == "comments":
            each = self.pick(["article", "div", "li"])
            says = "".join(
                f"<{each}{self.named(role)}>" + self.pick([f"<b>{html.escape(self.prose(1, 2))}</b> ", f"<h4>{html.escape(self.prose(1, 3))}</h4>", ""])
                + f"<p>{html.escape(self.prose(3, 60))}{self.end('p')}" + self.pick(["", '<a href="#r">Reply</a>']) + f"</{each}>" for _ in range(r.randint(1, 4))
            )
            inside = (f"<{(h := self.pick(['h2', 'h3', 'div']))}>{phrase}</{h}>" if self.chance(0.8) else "") + (f"<ol>{says}</ol>" if each == "li" else says)
        else:
            inside = f"{phrase} " + self.links(role, 4)
        return f"<{tag}{name}>{inside}</{tag}>"

    def article(self) -> str:
        """The main text's blocks, with adverts and the like among them."""
        title = self.prose(2, 10)
        lines = list(self.lines)
        out = []
        head = self.pick(["h1", "h1", "h1", "h2"])
        if self.chance(0.85):
            out.append(f"<header>{self.kept(head, title)}</header>" if self.chance(0.15) else self.kept(head, title))
        while lines:
            shape = self.random.random()
            if shape < 0.06 and len(lines) >= 2:
                tag = self.pick(["ul", "ol"])
                take = [lines.pop(0) for _ in range(min(len(lines), self.random.randint(2, 4)))]
                out.append(f"<{tag}>" + "".join(self.kept("li", x) for x in take) + f"</{tag}>")
            elif shape < 0.1:
                out.append(f"<blockquote>{self.kept('p', lines.pop(0))}</blockquote>")
            elif shape < 0.14:
                out.append(self.kept(self.pick(["h2", "h3"]), self.prose(1, 7)))
            elif shape < 0.17:
                cells = [self.prose(1, 5) for _ in range(self.random.randint(2, 6))]
                out.append("<table><tr>" + "".join(self.kept("td", c) for c in cells) + "</tr></table>")
            elif shape < 0.19:
                out.append(f'<figure><img src="x.png">{self.kept("figcaption", self.prose(2, 12))}</figure>')
            elif shape < 0.25:
                out.append(self.part(self.pick(["advert", "advert", "share", "form", "side", "notice"])))
            elif shape < 0.28:
                out.append(self.kept("p", self.prose(1, 3)))
            elif shape < 0.32:
                out.append(self.kept("div", lines.pop(0)))
            else:
                out.append(self.kept("p", lines.pop(0)))
        return "".join(out)

    def render(self) -> tuple[str, str]:
        """The page and its main text."""
        before = [self.part(x) for x in ("header", "menu", "notice", "advert", "side", "form") if self.chance(0.45)]
        self.random.shuffle(before)
        tag = self.pick(["article", "article", "article", "main", "div", "div", "section", "td"])
        around = self.pick(["main", "div", "div", "", ""])
        name = self.named("content") if tag in ("div", "section", "td") or self.chance(0.3) else ""
        body = f"<{tag}{name}>{self.article()}</{tag}>"
        inside_end = self.part("comments") if self.chance(0.15) else ""
        if tag == "td":
            side = f"<td class={self.pick(NAMES['side'])}>{self.part('side')}</td>" if self.chance(0.5) else ""
            body = f"<table><tr>{self.pick([side, ''])}{body}</tr></table>"
        if around:
            body = f"<{around}{self.named('content') if self.chance(0.4) else ''}>{body}{inside_end}</{around}>"
        after = [self.part(x) for x in ("share", "comments", "comments", "side", "advert", "form", "notice", "menu") if self.chance(0.3)]
        if self.chance(0.8):
            after.append(self.part("footer"))
        head = f"<head><meta charset=utf-8><title>{html.escape(self.prose(2, 8))}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        comment = "<!-- <p>not shown</p> -->" if self.chance(0.3) else ""
        page = f"<!DOCTYPE html><html>{head}<body{self.pick(['', ' class=page'])}>{comment}{''.join(before)}{body}{''.join(after)}"
        if not self.chance(0.2):
            page += "</body></html>"
        return page, "\n\n".join(self.gold)


def labelled_pages(docs: DataFrame, count: int = TRAIN_PAGES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, html, text): ``count`` pages set from the texts whose ids hash lowest; fewer if there are fewer ids.

    The same pages at every partitioning. Rows that share an id give a page
    each; null and empty texts give pages of one word.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [Page((t or "").split("\n"), seed).render() for t, seed in zip(batch["text"], batch["seed"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "html": [m[0] for m in made], "text": [m[1] for m in made]})

    sample = lowest_hashes(docs, id_col, F.lit(0), count)
    rows = texts_of(docs, sample, id_col, text_col).select(F.col("id").cast("string"), "text", F.xxhash64("id", F.lit(3)).alias("seed"))
    return rows.mapInPandas(run, "id string, html string, text string")
