"""Column -> Column helpers shared by models, checks and reconciliation.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_count(c: ColumnLike) -> Column:
    """``count(*) - count(c)``: nulls in a column, as an aggregate."""
    return F.count(F.lit(1)) - F.count(_col(c))


def surrogate_key(*cols: ColumnLike, sep: str = "~") -> Column:
    """``md5(a || sep || b ...)`` over the text of each part.

    ``concat`` propagates nulls, so a null part gives a null key, which the
    ``not_null`` check on the key then reports.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.md5(F.concat(*parts))


def is_close(a: ColumnLike, b: ColumnLike, abs_tol: float = 0.01, rel_tol: float = 1e-9) -> Column:
    """Python's ``math.isclose`` as a Column (I11): inclusive bound,
    ``|a-b| <= max(rel_tol * max(|a|, |b|), abs_tol)``.  Null if either side is null."""
    a, b = _col(a), _col(b)
    bound = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    return F.abs(a - b) <= bound


def normalized(c: ColumnLike) -> Column:
    """``lower(trim(c))`` (I9).  Spark trims only U+0020."""
    return F.lower(F.trim(_col(c)))


def has_prefix(c: ColumnLike, prefix: ColumnLike, case_insensitive: bool = False) -> Column:
    """Plain prefix match (E5/E6): ``_`` and ``%`` in the prefix are literal."""
    c, p = _col(c), _col(prefix)
    if case_insensitive:
        c, p = F.lower(c), F.lower(p)
    return c.startswith(p)


def null_safe_equal(a: ColumnLike, b: ColumnLike) -> Column:
    """``a <=> b``: two nulls are equal, null vs value is not."""
    return _col(a).eqNullSafe(_col(b))


def money_round(c: ColumnLike) -> Column:
    """``round(c, 2)``."""
    return F.round(_col(c), 2)
