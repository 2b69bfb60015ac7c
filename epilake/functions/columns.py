"""Scalar column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen. Inputs that can be malformed use the
``try_*`` family: results never depend on the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# The age bins of the case-distribution report. The first bin is
# open below (x < 18), the middle ones are closed ranges (18..29, 30..49,
# 50..64), the last is open above (x >= 65); anything else, such as a
# fractional age between two ranges, falls to the fallback label.
AGE_BINS: tuple[tuple[str, float | None, float | None], ...] = (
    ("0-17", None, 18),
    ("18-29", 18, 29),
    ("30-49", 30, 49),
    ("50-64", 50, 64),
    ("65+", 65, None),
)
AGE_FALLBACK = "Unknown"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_code(c: str | Column, width: int = 2) -> Column:
    """Code as a zero-padded string: 5, '5' and '05' all become '05'.

    Longer codes are kept whole (``lpad`` alone would cut them).
    """
    s = F.trim(_col(c).cast("string"))
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def as_date(c: str | Column, source_type: DataType | None = None) -> Column:
    """Parse to DATE without ever raising: bad text becomes null.

    Dates pass through, timestamps are truncated, strings go through
    ``try_to_date`` (ISO date, optionally followed by a time part).
    """
    col = _col(c)
    if isinstance(source_type, DateType):
        return col
    if isinstance(source_type, (TimestampType, TimestampNTZType)):
        return F.to_date(col)
    return F.try_to_date(col.cast("string"))


def rate_per_n_expr(value: str | Column, population: str | Column,
                    per: float = 100000.0) -> Column:
    """``value * per / population`` in double arithmetic, null unless the
    population is known and positive (never a division by zero)."""
    pop = _col(population)
    return F.when(pop.isNotNull() & (pop > 0),
                  (_col(value) * F.lit(float(per))) / pop)


def round2(c: str | Column, scale: int = 2) -> Column:
    """Round half-up to ``scale`` places."""
    return F.round(_col(c), scale)


def bin_label(c: str | Column,
              bins: Sequence[tuple[str, float | None, float | None]] = AGE_BINS,
              fallback: str = AGE_FALLBACK) -> Column:
    """Searched CASE from a list of ``(label, low, high)``.

    ``low is None`` means ``x < high``; ``high is None`` means ``x >= low``;
    otherwise ``low <= x <= high``. First match wins, else ``fallback``.
    """
    x = _col(c)
    expr = None
    for label, lo, hi in bins:
        if lo is None:
            cond = x < F.lit(hi)
        elif hi is None:
            cond = x >= F.lit(lo)
        else:
            cond = x.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fallback))
