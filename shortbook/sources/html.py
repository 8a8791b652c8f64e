"""HTML pages -> records.

Input is a table of pages ``(page_id, html)``. Navigation links come from
built-in expressions. Nested structures (article paragraphs, meeting rows)
need the element nesting: each task reads its pages once with the
standard-library tokenizer and emits a record when its element closes. No
tree is built, so depth costs a stack entry and nothing else.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortbook.names import col as qcol

# elements without an end tag; elements that end an open paragraph; markup inside paragraphs
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_P = frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 article section nav header footer pre "
                    "blockquote form hr".split())
_INLINE = frozenset("a b em i span strong".split())


class _Region:
    """An open element that a record is made of: its text so far."""

    __slots__ = ("role", "attrs", "text", "found")

    def __init__(self, role: str, attrs: dict):
        self.role, self.attrs, self.text, self.found = role, attrs, [], {}

    def words(self) -> str:
        return " ".join("".join(self.text).split())


class RecordReader(HTMLParser):
    """Feeds page events to two rules: ``role(tag, attrs, inside)`` names the
    region an element opens (or None), given the roles open around it;
    ``done(region, around)`` is told when it closes."""

    def __init__(self, role: Callable, done: Callable):
        super().__init__(convert_charrefs=True)
        self._role, self._done = role, done
        self._elements: list[tuple[str, bool]] = []  # (tag, opened a region)
        self._regions: list[_Region] = []
        self._hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            for depth in range(len(self._elements) - 1, -1, -1):
                above = self._elements[depth][0]
                if above == "p":
                    self._end(depth)
                if above == "p" or above not in _INLINE:
                    break
        if tag in _VOID:
            return
        given = {k: v or "" for k, v in attrs}
        role = self._role(tag, given, [r.role for r in self._regions])
        self._elements.append((tag, role is not None))
        self._hidden += tag in ("script", "style")
        if role is not None:
            self._regions.append(_Region(role, given))

    def handle_endtag(self, tag):
        for depth in range(len(self._elements) - 1, -1, -1):
            if self._elements[depth][0] == tag:
                self._end(depth)
                return

    def handle_data(self, data):
        if not self._hidden:
            for region in self._regions:
                region.text.append(data)

    def close(self):
        super().close()
        self._end(0)

    def _end(self, depth: int) -> None:
        while len(self._elements) > depth:
            tag, opened = self._elements.pop()
            self._hidden -= tag in ("script", "style")
            if opened:
                region = self._regions.pop()
                self._done(region, self._regions)


def _read(html: str | None, role: Callable, done: Callable) -> None:
    reader = RecordReader(role, done)
    reader.feed(html or "")
    reader.close()


def _map_pages(pages: DataFrame, id_col: str, html_col: str, records: Callable, columns: list[str],
               schema: str, error: Callable) -> DataFrame:
    """One output frame per input batch; a page that fails yields ``error``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for pid, html in zip(batch["_id"], batch["_html"], strict=True):
                pid = None if pd.isna(pid) else int(pid)
                try:
                    rows += [(pid, *r) for r in records(html)]
                except Exception as e:  # noqa: BLE001 - malformed input must not kill the job
                    rows.append((pid, *error(f"{type(e).__name__}: {e}")))
            yield pd.DataFrame(rows, columns=columns)

    return pages.select(qcol(id_col).cast("long").alias("_id"), qcol(html_col).alias("_html")).mapInPandas(run, schema)


# ------------------------------------------------------------------ navigation links

_ATTRS = r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
# the tags that open and close navigation, and links up to where they end
_LINK = rf"<a\b{_ATTRS}>(.*?)(?:</a\s*>|(?=<a\b|</?nav\b)|\z)"
_PART = rf"(?is)<nav\b{_ATTRS}>|</nav\s*>|{_LINK}"
_HREF = r"(?is)(?:^|\s)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_PIECE = r"(?i)&(?:#[0-9]{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]*);|[^&]+|&"
# named references, and the numbers that stand for other characters
_NAMED = {k: v for k, v in html5.items() if k.endswith(";")} | {"nbsp;": " "} \
    | {f"{n};": unescape(f"&#{n};") for n in range(128, 160)}


def _plain(c: Column) -> Column:
    """Character references that end with a semicolon become characters."""
    named = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")

    def piece(x: Column) -> Column:
        number = F.when(F.lower(F.substring(x, 3, 1)) == "x", F.conv(F.regexp_extract(x, "(?i)x([0-9a-f]+)", 1), 16, 10)) \
            .otherwise(F.regexp_extract(x, "#([0-9]+)", 1)).try_cast("long")
        known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(known, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
        numeric = F.when(number.between(128, 159), F.try_element_at(named, F.concat(number.cast("string"), F.lit(";")))) \
            .otherwise(char)
        return F.when((F.length(x) < 3) | ~x.startswith("&"), x).when(x.startswith("&#"), numeric) \
            .otherwise(F.coalesce(F.try_element_at(named, F.substring(x, 2, 40)), x))

    return F.when(c.contains("&"), F.array_join(
        F.transform(F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0)), piece), "")).otherwise(c)


def nav_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, pos, text, href) of the links inside ``<nav>`` elements, by
    built-in expressions only. Comments and scripts count for nothing, an open
    ``<nav>`` lasts to the end, a link in nested ones is one row; a link
    without ``href`` has none."""
    parts = F.regexp_extract_all(F.regexp_replace(qcol(html_col), _HIDDEN, ""), F.lit(_PART), F.lit(0))
    links = F.expr("""
      aggregate(_parts, named_struct('depth', 0, 'links', cast(array() as array<string>)),
        (s, p) -> named_struct(
          'depth', case when lower(left(p, 4)) = '<nav' then s.depth + 1
                        when lower(left(p, 5)) = '</nav' then greatest(s.depth - 1, 0) else s.depth end,
          'links', if(s.depth > 0 and lower(left(p, 4)) <> '<nav' and lower(left(p, 5)) <> '</nav',
                      array_append(s.links, p), s.links)),
        s -> s.links)""")
    link = F.col("_link")
    attrs = F.regexp_extract(link, "(?is)^" + _LINK, 1)
    text = F.regexp_replace(F.regexp_extract(link, "(?is)^" + _LINK, 2), "(?s)<[^>]*>", "")
    href = F.when(attrs.rlike(_HREF), F.concat(*[F.regexp_extract(attrs, _HREF, k) for k in (1, 2, 3)])) \
        .when(attrs.rlike(r"(?is)(?:^|\s)href(?:\s|$)"), F.lit(""))
    return (pages.select(qcol(id_col).cast("long").alias("page_id"), parts.alias("_parts"))
            .select("page_id", F.posexplode(links).alias("pos", "_link"))
            .select("page_id", "pos", F.trim(text).alias("_text"), href.alias("_href"))
            .select("page_id", "pos", _plain(F.col("_text")).alias("text"), _plain(F.col("_href")).alias("href")))


# ------------------------------------------------------------------ generic records

RECORD_SCHEMA = "page_id long, kind string, pos int, text string, href string"


def page_records(html: str | None) -> list[tuple]:
    """(kind, pos, text, href): h1 headings, article paragraphs."""
    found: dict[str, list[tuple]] = {"h1": [], "paragraph": []}

    def role(tag, attrs, inside):
        if tag == "article" or tag == "h1":
            return tag
        return "paragraph" if tag == "p" and "article" in inside else None

    def done(region, around):
        if region.role in found:
            own = found[region.role]
            own.append((region.role, len(own), region.words(), None))

    _read(html, role, done)
    return found["h1"] + found["paragraph"]


def html_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """R10 (generic): headings, navigation links and article paragraphs; a
    page that cannot be read yields one ``parse_error`` row."""
    nested = _map_pages(pages, id_col, html_col, page_records, ["page_id", "kind", "pos", "text", "href"],
                        RECORD_SCHEMA, lambda m: ("parse_error", 0, m, None))
    links = nav_links(pages, id_col, html_col).select("page_id", F.lit("nav_link").alias("kind"), "pos", "text", "href")
    return nested.unionByName(links)


# ------------------------------------------------------------------ meeting calendar pages

MEETING_SCHEMA = ("page_id long, Year string, Month string, Dates string, minutes_text string, href string, "
                  "error string")
# fixed values of the published pages
_ARTICLE_ID = "article"
_SECTION, _HEADING, _ROW = "panel-default", "panel-heading", "fomc-meeting"
_CELLS = {"fomc-meeting__month": "month", "fomc-meeting__date": "dates", "fomc-meeting__minutes": "minutes"}
_YEAR_SUFFIX, _TRANSCRIPT_LINK = "FOMC Meetings", "HTML"


def page_meetings(html: str | None) -> list[tuple]:
    """(Year, Month, Dates, minutes_text, href, error) per meeting row, emitted
    when the row closes. A section's heading link sets the year for it and the
    sections after it."""
    rows: list[tuple] = []
    year: list[str | None] = [None]

    def role(tag, attrs, inside):
        names = set(attrs.get("class", "").split())
        if tag == "a":
            return "link" if "heading" in inside or "minutes" in inside else None
        if tag != "div":
            return None
        if "article" not in inside:
            return "article" if attrs.get("id") == _ARTICLE_ID else None
        if "section" not in inside:
            return "section" if _SECTION in names else None
        if "row" in inside:
            return next((r for c, r in _CELLS.items() if c in names and r not in inside), None)
        if _ROW in names:
            return "row"
        return "heading" if _HEADING in names else None

    def done(region, around):
        if region.role == "link":
            text, outer = region.words(), around[-1]
            if outer.role == "heading" and text.endswith(_YEAR_SUFFIX):
                year[0] = text.split()[0]
            elif outer.role == "minutes" and text == _TRANSCRIPT_LINK and "href" in region.attrs:
                outer.found.setdefault("href", region.attrs["href"])
        elif region.role in _CELLS.values():
            row = around[-1].found
            row.setdefault(region.role, region.words())
            if "href" in region.found:
                row.setdefault("href", region.found["href"])
        elif region.role == "row":
            cell = region.found.get
            rows.append((year[0], cell("month"), cell("dates"), cell("minutes"), cell("href"), None))

    _read(html, role, done)
    return rows


def meeting_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """R10 (meeting calendar): raw meeting rows, one per row element; a page
    that cannot be read yields one row with ``error`` set."""
    return _map_pages(pages, id_col, html_col, page_meetings,
                      ["page_id", "Year", "Month", "Dates", "minutes_text", "href", "error"],
                      MEETING_SCHEMA, lambda m: (None, None, None, None, None, m))
