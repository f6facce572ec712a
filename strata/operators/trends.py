"""Year-on-year change.

``lag`` compares each row with the previous *row* of its key, as the source
marts do: with 2017-2019 missing, 2020 is compared with 2016.  ``strict``
compares only with the immediately preceding period.

:func:`yoy` is for marts: a window per key, or one over yearly rows.
:func:`yoy_in_order` is for whole tables: it has no key to spread by, or a key that
holds much of the table, and works range by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ranges import with_previous


def yoy(df: DataFrame, value: str, order: str = "year", keys: list[str] | None = None, *,
        pct: str | None = "yoy_change_pct", change: str | None = None,
        pct_digits: int = 2, change_digits: int = 0, strict: bool = False,
        aggregated: bool = False) -> DataFrame:
    """Add percent change (W3) and optionally absolute change (W4) over ``order``.

    With ``keys`` the window is partitioned by them (W1).  Without keys the
    window is global and runs in a single task (W2); that is only sound on
    an input already aggregated to one row per ``order`` value, so the
    caller must confirm it with ``aggregated=True``.

    A zero or null previous value gives a null percent, never an error.
    """
    if not keys and not aggregated:
        raise ValueError("yoy without keys needs an input aggregated per period "
                         "(pass aggregated=True) -- a global window is one task")
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
    prev = F.lag(value, 1).over(w)
    if strict:
        prev = F.when(F.lag(order, 1).over(w) == F.col(order) - 1, prev)
    out = df.withColumn("_prev", prev)
    diff = F.col(value) - F.col("_prev")
    cols = {}
    if change:
        cols[change] = F.round(diff, change_digits)
    if pct:
        cols[pct] = F.round(F.try_divide(diff, F.col("_prev")) * 100, pct_digits)
    return out.withColumns(cols).drop("_prev")


def yoy_in_order(df: DataFrame, value: str, order: str, keys: list[str] | None = None, *,
                 ties: list[str] | None = None, previous: str | None = None,
                 pct: str | None = "yoy_change_pct", change: str | None = None,
                 pct_digits: int = 2, change_digits: int = 0) -> DataFrame:
    """Change against the row before in ``order``, over a table of any size.

    Same columns as :func:`yoy` (and the value before itself as ``previous``), without
    a window over all rows or over a hot key: rows go to ranges of (``keys``, ``order``)
    and the last row of each range is carried to the next.  Nulls in ``order`` come
    first.  Rows with one ``order`` are told apart by ``ties``, by default all other
    columns that can be ordered, ``value`` first, so that the result does not depend
    on how rows were stored; rows equal in all columns are interchangeable.
    """
    keys = keys or []
    if ties is None:
        rest = [f.name for f in df.schema.fields if f.name not in (*keys, order, value) and _orderable(f.dataType)]
        ties = [value, *rest]
    out = with_previous(df, [order, *ties], [value], keys)
    before = F.col(f"_prev.`{value}`")
    diff = F.col(value) - before
    cols = {}
    if previous:
        cols[previous] = before
    if change:
        cols[change] = F.round(diff, change_digits)
    if pct:
        cols[pct] = F.round(F.try_divide(diff, before) * 100, pct_digits)
    return out.withColumns(cols).drop("_prev")


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType))
