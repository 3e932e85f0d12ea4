"""HTML to Markdown on the standard library's parser, as a vectorised function."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parley.functions import text as T
from parley.session import ship

_MARKS = {"b": "**", "strong": "**", "em": "*", "i": "*", "del": "~~", "s": "~~", "code": "`", "kbd": "`", "samp": "`"}
_BLOCKS = frozenset("address article aside blockquote body dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header html li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
_SKIP = frozenset(("script", "style", "head", "template", "noscript"))
_GAPS = re.compile("\n\n\n+")
_SPACE = re.compile(r"[ \t\r\n\f]+")


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = self.pre = 0
        self.lists: list[list] = []
        self.links: list[str | None] = []

    def block(self, gap: str) -> None:
        while self.out and not self.out[-1].strip(" "):
            self.out.pop()
        if self.out and not self.out[-1].endswith("\n" * len(gap)):
            tail = len(self.out[-1]) - len(self.out[-1].rstrip("\n"))
            self.out.append("\n" * max(0, len(gap) - tail))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        have = dict(attrs)
        if tag in _SKIP:
            self.skip += 1
        elif tag in _MARKS and not self.pre:
            self.out.append(_MARKS[tag])
        elif tag == "br":
            self.out.append("\n" if self.pre else "  \n")
        elif tag == "hr":
            self.block("\n\n")
            self.out.append("---\n\n")
        elif tag == "a":
            self.links.append(have.get("href"))
            if have.get("href"):
                self.out.append("[")
        elif tag == "img":
            self.out.append(f"![{have.get('alt') or ''}]({have.get('src') or ''})")
        elif tag in ("ul", "ol"):
            self.block("\n" if self.lists else "\n\n")
            self.lists.append([tag, int(have.get("start") or 1) if (have.get("start") or "1").isdigit() else 1])
        elif tag == "li":
            self.block("\n")
            kind = self.lists[-1] if self.lists else ["ul", 1]
            self.out.append("  " * (len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "* "))
            kind[1] += 1
        elif tag == "pre":
            self.block("\n\n")
            self.out.append("```\n")
            self.pre += 1
        elif tag in ("td", "th"):
            self.out.append("| ")
        elif tag in _BLOCKS:
            self.block("\n" if tag == "tr" else "\n\n")
            if tag[0] == "h" and tag[1:].isdigit():
                self.out.append("#" * int(tag[1:]) + " ")
            elif tag == "blockquote":
                self.out.append("> ")

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in _MARKS and not self.pre:
            self.out.append(_MARKS[tag])
        elif tag == "a" and self.links:
            href = self.links.pop()
            if href:
                self.out.append(f"]({href})")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.block("\n" if self.lists else "\n\n")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag == "tr":
            self.out.append("|\n")
        elif tag in _BLOCKS:
            self.block("\n" if tag == "li" else "\n\n")

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if not self.pre:
            data = _SPACE.sub(" ", data)
            if data.startswith(" ") and (not self.out or self.out[-1].endswith(("\n", " "))):
                data = data[1:]
        if data:
            self.out.append(data)


def convert(html: str | None) -> str | None:
    """Markdown of a page or fragment; null stays null. Broken markup is read as far as it goes."""
    if html is None:
        return None
    reader = _Markdown()
    reader.feed(html)
    reader.close()
    return _GAPS.sub("\n\n", "".join(reader.out)).strip("\n")


def _convert_all(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for p in parts:
        yield p.map(convert, na_action="ignore")


def to_markdown(html: Column) -> Column:
    """Markdown of a column of HTML, batch by batch."""
    ship(SparkSession.getActiveSession())
    return F.pandas_udf(_convert_all, StringType(), F.PandasUDFType.SCALAR_ITER)(html)


# -- what surrounds the conversion, as plain expressions --------------------
def drop_openings(html: Column, tags: tuple[str, ...] = ("div", "span")) -> Column:
    """Remove opening tags, on one line each."""
    for t in tags:
        html = T.sub(html, f"(?d)<{t}.*?>")
    return html


def mend_fences(md: Column) -> Column:
    """Fences that a copy button broke: its language goes to the fence, its caption goes."""
    return T.sub(md, "(?s)```(.+?)Copy code(.+?)```", "```$1\n$2```")


def drop_counter(md: Column) -> Column:
    """Remove a leading ``n / m``."""
    return T.sub(md, "\\A[0-9]+ / [0-9]+")


def drop_copy_captions(md: Column) -> Column:
    """Remove captions that count characters and words, and empty fences."""
    return T.sub(T.sub(md, "Copy[0-9]+ chars / [0-9]+ words"), f"(?U)```{T.WS}*```")


def compact(md: Column) -> Column:
    """Strip the ends of lines, squeeze three and more line feeds to two, strip."""
    return T.strip(T.squeeze_newlines(T.rstrip_lines(md), 3))


def residue(md: Column) -> Column:
    """Whether something is left that marks a failed conversion."""
    return md.contains("{r}") | md.contains("Copy code`") | md.contains(".terminal-")


def drop_elements(html: Column, tag: str) -> Column:
    """Remove elements with their content, up to the next end tag; an unbalanced one ends it."""
    return T.sub(html, f"(?s)<{tag}.*?</{tag}>")


def drop_quotes_and_scripts(html: Column) -> Column:
    """Quotations and scripts always; ``div`` only where the text holds wrapped images."""
    out = drop_elements(drop_elements(html, "blockquote"), "script")
    return F.when(html.contains("bbImageWrapper"), drop_elements(out, "div")).otherwise(out)


def loosen_emphasis(md: Column) -> Column:
    """Tight emphasis marks inside words get a space, in turn before and after."""
    mark = "(?U)(?=\\*)(?<=\\w)\\*{1,2}(?=\\w)"
    between, marks = F.split(md, mark, -1), F.regexp_extract_all(md, F.lit(mark), F.lit(0))
    spaced = F.transform(marks, lambda m, i: F.when(i % 2 == 0, F.concat(F.lit(" "), m)).otherwise(F.concat(m, F.lit(" "))))
    # Zipped, for a lambda that names the marks would find all of them again for each piece.
    return F.array_join(F.zip_with(between, spaced, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")
