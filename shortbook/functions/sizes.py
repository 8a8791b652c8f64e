"""Human-readable byte sizes with PostgreSQL ``pg_size_pretty`` rules.

Units bytes, kB, MB, GB, TB, PB (1024 steps). A size stays in a unit while
its magnitude is below 10240 of it; from kB up the value is kept in half
units and rounded half away from zero. Integer division truncates toward
zero, as in C.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = ["kB", "MB", "GB", "TB", "PB"]
_HALF_LIMIT = 20 * 1024 - 1


def _tdiv(x: Column, d: int) -> Column:
    """Integer division truncating toward zero (Java ``%`` keeps the sign)."""
    return ((x - x % F.lit(d)) / F.lit(d)).cast("long")


def _half_rounded(x: Column) -> Column:
    return _tdiv(x + F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)), 2)


def size_pretty(c) -> Column:
    size = (F.col(c) if isinstance(c, str) else c).cast("long")
    out = F.when(F.abs(size) < 10 * 1024, F.concat(size.cast("string"), F.lit(" bytes")))
    cur = _tdiv(size, 1 << 9)  # half-kB units
    for i, unit in enumerate(_UNITS):
        label = F.concat(_half_rounded(cur).cast("string"), F.lit(" " + unit))
        if i == len(_UNITS) - 1:
            out = out.otherwise(label)
        else:
            out = out.when(F.abs(cur) < _HALF_LIMIT, label)
            cur = _tdiv(cur, 1 << 10)
    return out
