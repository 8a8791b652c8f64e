"""Column references from data-derived names.

Header names such as ``No. of ESTs`` contain dots; passed as plain strings,
Spark would read them as nested-field access. Quoted references are exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]
