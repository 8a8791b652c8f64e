"""Meeting-calendar expressions (V7, V8, V9).

FIXED VALUES: link host https://www.federalreserve.gov/ (joined with '/'
plus the href, which may itself start with '/'); release marker "Released";
flag words "unscheduled", "cancelled", "notation vote" (checked in that
order, first match wins) and the removed texts "(unscheduled)",
"(cancelled)", "(notation vote)"; '*' marks economic projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortbook.functions.text import strip

LINK_HOST = "https://www.federalreserve.gov/"
RELEASE_MARKER = "Released"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def release_date(text) -> Column:
    """V8: text after the last marker, stripped, last character dropped,
    stripped again, then quotes stripped. Null when the marker is absent."""
    t = _c(text)
    tail = F.regexp_extract(t, "(?s)^.*" + RELEASE_MARKER + "(.*)$", 1)  # greedy: after the last one
    cut = F.regexp_replace(strip(tail), "(?s).$", "")  # drop the last character
    return F.when(t.contains(RELEASE_MARKER), F.trim(strip(cut), F.lit('"')))


def transcript_link(href, compat: bool = True) -> Column:
    """V9: host + href. ``compat`` keeps the doubled '/' the source produces
    for root-relative hrefs; otherwise one '/' is dropped."""
    h = _c(href)
    if compat:
        return F.when(h.isNotNull(), F.concat(F.lit(LINK_HOST), h))
    return F.when(h.isNotNull(), F.concat(F.lit(LINK_HOST), F.regexp_replace(h, "^/", "")))


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable, so
    later references (and predicates pushed below projections) do not copy
    the expression tree."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _flags(d0: Column) -> Column:
    proj = F.coalesce(d0.contains("*"), F.lit(False))

    def with_d1(d1: Column) -> Column:
        def with_low(low: Column) -> Column:
            uns = F.coalesce(low.contains("unscheduled"), F.lit(False))
            can = ~uns & F.coalesce(low.contains("cancelled"), F.lit(False))
            note = ~uns & ~can & F.coalesce(low.contains("notation vote"), F.lit(False))
            text = (F.when(uns, F.lit("(unscheduled)")).when(can, F.lit("(cancelled)"))
                    .when(note, F.lit("(notation vote)")))
            dates = F.when(uns | can | note, strip(F.replace(low, text, F.lit("")))).otherwise(d1)
            return F.struct(proj.alias("p"), uns.alias("u"), can.alias("c"), note.alias("n"), dates.alias("d"))
        return _bind(F.lower(d1), with_low)

    return _bind(F.when(proj, strip(F.regexp_replace(d0, r"\*", ""))).otherwise(d0), with_d1)


def meeting_flags(df: DataFrame, dates_col: str = "Dates") -> DataFrame:
    """V7: projections flag from '*', then the first of unscheduled /
    cancelled / notation vote (case-insensitive); the date text is
    lower-cased and the exact "(...)" note removed when a flag is found."""
    f = _bind(F.col(dates_col), _flags).alias("_f")
    return df.select(
        *[c for c in df.columns if c != dates_col], f
    ).select(
        *[c for c in df.columns if c != dates_col],
        F.col("_f.d").alias(dates_col),
        F.col("_f.p").alias("Summary of Economic Projections"),
        F.col("_f.u").alias("Unscheduled"),
        F.col("_f.c").alias("Cancelled"),
        F.col("_f.n").alias("Notation Vote"),
    )


def keep_complete(df: DataFrame, year="Year", month="Month", dates="Dates") -> DataFrame:
    """Rows are kept only with a year, a month and a (non-empty) date."""
    ok = F.lit(True)
    for c in (year, month, dates):
        ok = ok & (F.length(F.col(c).cast("string")) > 0)  # null or '' -> dropped
    return df.where(ok)
