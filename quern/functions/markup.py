"""Markup read by a state machine: one pass, linear in the text whatever is left unclosed, entities by table.

Regular expressions over whole pages backtrack on unclosed tags and take what
stands in scripts, comments and attributes for text; this reader does neither.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed elements whose content is no markup; of the last two, entities are read.
RAW = ("script", "style", "title", "textarea")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*")
_BLANK = re.compile(r"[\s/]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
#: Fewest rows of a full page of a listing, and the last page that is asked for.
FULL_PAGE, LAST_PAGE = 100, 29
#: Fixed wordings by which a listing says that it has nothing.
NOTHING = ("開示された情報はありません", "開示情報はありません")


class Reader:
    """(kind, value, attributes) of a page: kind is start, end or text. A tag, comment or quote that is never closed goes to the end of the page."""

    def __init__(self, html: str):
        self.html = html
        self.ends: dict[str, int] = {}  # where searches for a mark that is not there any more began

    def _find(self, mark: str, at: int) -> int:
        if at >= self.ends.get(mark, len(self.html) + 1):
            return -1
        found = self.html.find(mark, at)
        if found < 0:
            self.ends[mark] = min(at, self.ends.get(mark, at))
        return found

    def _tag(self, at: int) -> tuple[dict[str, str], int]:
        """Attributes of a start tag from after its name, the first of a name, and the place after it."""
        html, found = self.html, {}
        while True:
            at = _BLANK.match(html, at).end()
            if at >= len(html):
                return found, at
            if html[at] == ">":
                return found, at + 1
            name = _ATTRIBUTE.match(html, at)
            at, value = name.end(), ""
            if equals := _EQUALS.match(html, at):
                at = equals.end()
                quote = html[at : at + 1]
                closing = self._find(quote, at + 1) if quote and quote in "\"'" else -1
                if closing >= 0:
                    value, at = html[at + 1 : closing], closing + 1
                else:
                    bare = _BARE.match(html, at)
                    value, at = bare[0], bare.end()
            found.setdefault(name[0].lower(), unescape(value))

    def __iter__(self) -> Iterator[tuple[str, str, dict[str, str]]]:
        html, at, size, text = self.html, 0, len(self.html), 0

        def passed(to: int) -> Iterator[tuple[str, str, dict[str, str]]]:
            if to > text:
                yield "text", unescape(html[text:to]), {}

        while at < size:
            start = self._find("<", at)
            if start < 0:
                break
            following = html[start + 1 : start + 2]
            if following in ("!", "?"):
                mark = "-->" if html.startswith("<!--", start) else ">"
                end = self._find(mark, start + 2)
                yield from passed(start)
                at = text = size if end < 0 else end + len(mark)
            elif following == "/" and _NAME.match(html, start + 2):
                end = self._find(">", start)
                yield from passed(start)
                yield "end", _NAME.match(html, start + 2)[0].lower(), {}
                at = text = size if end < 0 else end + 1
            elif name := _NAME.match(html, start + 1):
                yield from passed(start)
                tag = name[0].lower()
                attributes, at = self._tag(name.end())
                yield "start", tag, attributes
                text = at
                if tag in RAW:
                    closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    end = closing.start() if closing else size
                    if end > at:
                        yield "text", html[at:end] if tag in RAW[:2] else unescape(html[at:end]), {}
                    at = text = end
            else:
                at = start + 1
        yield from passed(size)


def anchors_of(html: str | None) -> list[dict[str, str]]:
    """href and text of the anchors that have a href, in order; a text ends with its anchor or where the next begins."""
    found: list[dict[str, str]] = []
    inside = False
    for kind, value, attributes in Reader(html or ""):
        if kind == "start" and value == "a":
            inside = bool(attributes.get("href"))
            if inside:
                found.append({"href": attributes["href"], "text": ""})
        elif kind == "end" and value == "a":
            inside = False
        elif kind == "text" and inside:
            found[-1]["text"] += value
    return [{"href": a["href"], "text": " ".join(a["text"].split())} for a in found]


def visible_of(html: str | None) -> str | None:
    """The words of a page outside its scripts and styles, joined by one blank."""
    if html is None:
        return None
    out, skipped = [], ""
    for kind, value, _ in Reader(html):
        if kind == "start":
            skipped = value if value in RAW[:2] else ""
        elif kind == "end":
            skipped = ""
        elif not skipped:
            out.append(value)
        if kind != "text":
            out.append(" ")
    return " ".join("".join(out).split())


def cells_of(html: str | None, classes: Mapping[str, str], link: str) -> list[dict[str, str]]:
    """The rows of a page's tables as maps of the cells of the classes named, whole rows only; the `link` cell's target is under href."""
    rows: list[dict[str, str]] = []
    row: dict[str, str] | None = None
    key, held, href = None, [], None
    for kind, value, attributes in Reader(html or ""):
        if kind == "start" and value == "tr":
            row = {}
        elif kind == "start" and value == "td" and row is not None:
            marks = set((attributes.get("class") or "").split())
            if named := next((k for c, k in classes.items() if c in marks), None):
                key, held = named, []
        elif kind == "start" and value == "a" and key == link and attributes.get("href"):
            href = attributes["href"]
        elif kind == "text" and key:
            held.append(value)
        elif kind == "end" and value == "td" and key and row is not None:
            row[key] = " ".join("".join(held).split())
            if key == link and href:
                row["href"] = href
            key, held, href = None, [], None
        elif kind == "end" and value == "tr" and row is not None:
            if set(classes.values()) <= row.keys():
                rows.append(row)
            row = None
    return rows


def anchors(html: Column) -> Column:
    """An array of href and text, a page's anchors."""

    @F.pandas_udf("array<struct<href:string,text:string>>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(anchors_of)

    return read(html)


def visible(html: Column) -> Column:
    """The words of a page outside its scripts and styles."""

    @F.pandas_udf("string")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(visible_of)

    return read(html)


def cells(html: Column, classes: Mapping[str, str], link: str) -> Column:
    """An array of maps, a row of the page's tables each."""

    @F.pandas_udf("array<map<string,string>>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: cells_of(p, classes, link))

    return read(html)


def listing(pages: DataFrame, keys: list[str], classes: Mapping[str, str], link: str, full: int = FULL_PAGE, last: int = LAST_PAGE) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of a listing in pages (keys, page from 1, html; null html where the service has no such page).

    Pages count up to the first that is missing or holds fewer than `full` rows,
    that one included, and no further than `last`; later ones are not read. A key
    whose first page is there, has no rows and does not say so (NOTHING) is
    EMPTY_FIRST_PAGE; a key that has no first page at all gives nothing. rows: keys, page, position, row (a map).
    """
    read = pages.where(F.col("page") <= last).withColumn("_rows", cells(F.col("html"), classes, link)).withColumn("_n", F.when(F.col("html").isNotNull(), F.size("_rows")).otherwise(-1))
    order = Window.partitionBy(*keys).orderBy("page")
    whole = F.min((F.col("_n") >= full).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    there = (F.coalesce(whole, F.lit(1)) == 1) & (F.row_number().over(order) == F.col("page")) & (F.col("_n") >= 0)
    kept = read.withColumn("_there", there).where("_there")
    rows = kept.select(*keys, "page", F.posexplode("_rows").alias("position", "row"))
    says_so = F.greatest(*(F.contains("html", F.lit(n)) for n in NOTHING))
    issues = kept.where((F.col("page") == 1) & (F.col("_n") == 0) & ~says_so).select(*keys, F.lit("EMPTY_FIRST_PAGE").alias("code"))
    return rows, issues
