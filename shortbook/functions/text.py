"""Text, money and identifier expressions (V1-V6, V13, V14). Pure Columns.

FIXED VALUES: filing link prefix https://www.sec.gov/Archives/edgar/data/
(then ``{cik}/{accession_number}.txt``); CIK width 10.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

FILING_LINK_PREFIX = "https://www.sec.gov/Archives/edgar/data/"
CIK_WIDTH = 10


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every code point Python's str.strip() removes (str.isspace), by rule.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip(c) -> Column:
    """V3 ``str.strip()``: trim every leading/trailing whitespace code point
    (a character-set trim, no regex)."""
    return F.trim(col(c), F.lit(WHITESPACE))


def zfill(c, width: int = CIK_WIDTH) -> Column:
    """V1 ``str.zfill``: left-pad with zeros after an optional sign; never
    truncates (a bare ``lpad`` would)."""
    s = col(c).cast("string")
    signed = s.rlike(r"^[+-]")
    body = F.when(signed, F.substring(s, 2, 1 << 30)).otherwise(s)
    pad_to = F.when(signed, F.lit(width - 1)).otherwise(F.lit(width))
    padded = F.when(F.length(body) < pad_to, F.lpad(body, pad_to, "0")).otherwise(body)
    return F.when(signed, F.concat(F.substring(s, 1, 1), padded)).otherwise(padded)


def filing_link(cik, accession) -> Column:
    """V2: archive link from the *unpadded* CIK and the accession number."""
    return F.concat(F.lit(FILING_LINK_PREFIX), col(cik).cast("string"), F.lit("/"), col(accession), F.lit(".txt"))


def null_placeholders(c, tokens=("NA", "")) -> Column:
    """V4: placeholder text -> null."""
    return F.when(~col(c).isin(list(tokens)), col(c))


def to_double(c) -> Column:
    """V4: numeric coercion, bad text -> null (``try_cast``), NaN -> null."""
    return _number(col(c).cast("string"))


# text that a number may have; Java's own suffixes (5d, 1.5F) are not numbers
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"


def _number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def clean_numeric(c, remove_dollar: bool = True) -> Column:
    """V5, reference-equal: drop ',', '$' (optional) and '(' ')' then parse.
    The parentheses' negative sign is *dropped*, as in the original check."""
    chars = r"[,$()]" if remove_dollar else r"[,()]"
    return _number(F.regexp_replace(col(c).cast("string"), chars, ""))


def clean_money(c, signed: bool = True) -> Column:
    """V5, signed variant: ``($1.19)`` -> -1.19, ``$1,234`` -> 1234.0."""
    v = clean_numeric(c)
    if not signed:
        return v
    neg = col(c).cast("string").rlike(r"^\s*\(.*\)\s*$")
    return F.when(neg, -v).otherwise(v)


def file_stem(name) -> Column:
    """V6 ``Path.stem``: file name without its last suffix."""
    return F.regexp_replace(col(name), r"(?<=.)\.[^.]*$", "")


def file_prefix(name, sep: str = "_") -> Column:
    """V6: text before the first ``sep`` of the file stem (e.g. 10-K)."""
    return F.substring_index(file_stem(name), sep, 1)


def new_run_id() -> str:
    """12 hex characters, generated once on the driver."""
    return uuid.uuid4().hex[:12]
