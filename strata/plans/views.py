"""Parameterised read views over the Gold tables.

Each view takes the Gold table as a DataFrame (``spark.table(name)`` for a
registered table) and cleaned keyword parameters, and returns a typed,
ordered DataFrame -- no SQL text is assembled, so user text reaches Spark
only as a bound literal.  Year bounds become ``BETWEEN`` on the partition
column, which Spark turns into partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.fixed_values import (LOCATION_EXTRA_CHARS, PRICES_COLUMNS, RENTS_COLUMNS, SALES_COLUMNS,
                                 SUMMARY_COLUMNS, TYPE_EXTRA_CHARS)
from strata.functions.values import contains_ci
from strata.operators.search import search_rows


def clean_param(value: str | None) -> str | None:
    """Strip blanks, then quotes, from a raw parameter."""
    if value is None:
        return None
    return str(value).strip().strip("\"'")


def clean_year(value: str | int | None, default: int | None = None) -> int | None:
    """Year parameter: quotes and blanks stripped, default when absent."""
    if value is None:
        return default
    cleaned = clean_param(str(value))
    return int(cleaned) if cleaned else default


def clean_text(value: str | None, extra: str) -> str | None:
    """Keep letters, digits and ``extra`` characters; blank -> None (F8)."""
    if not value:
        return None
    kept = "".join(c for c in clean_param(value) if c.isalnum() or c in extra)
    return kept or None


def _years(df: DataFrame, from_year, to_year) -> DataFrame:
    """Rows with a year within the given bounds; an absent bound is open."""
    lo, hi = clean_year(from_year), clean_year(to_year)
    df = df if lo is None else df.filter(F.col("year") >= lo)
    return df if hi is None else df.filter(F.col("year") <= hi)


def _top(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def summary(gold: DataFrame, from_year=None, to_year=None) -> DataFrame:
    """One row per year with every indicator (V1)."""
    return _years(gold, from_year, to_year).select(*SUMMARY_COLUMNS).orderBy("year")


def rents(gold: DataFrame, location: str | None = None, from_year=None, to_year=None,
          limit: int | None = None) -> DataFrame:
    """Rents by location and year, optional case-insensitive location match (V2).

    A ``limit`` is a top-k over a total order (location, year), so the rows
    kept never depend on scan order.
    """
    df = _years(gold, from_year, to_year)
    loc = clean_text(location, LOCATION_EXTRA_CHARS)
    if loc:
        df = df.filter(contains_ci("location", loc))
    return _top(df.select(*RENTS_COLUMNS).orderBy("location", "year"), limit)


def rents_of_many(gold: DataFrame, index: str, locations: list[str], from_year=None, to_year=None) -> DataFrame:
    """V2 for many location texts at once: ``location_searched`` and the rents rows it matches.

    ``index`` is a location index written with the Gold table
    (:func:`strata.operators.search.write_index`), so no text is compared with every
    location.  Texts are cleaned as for :func:`rents`; those of which nothing is left match
    nothing here.
    """
    spark = gold.sparkSession
    cleaned = [(c,) for c in {clean_text(x, LOCATION_EXTRA_CHARS) for x in locations} if c]
    needles = spark.createDataFrame(cleaned, "needle string")
    found = search_rows(spark, index, needles, _years(gold, from_year, to_year), "location")
    return (found.select(F.col("needle").alias("location_searched"), *RENTS_COLUMNS)
            .orderBy("location_searched", "location", "year"))


def prices(gold: DataFrame, type: str | None = None, from_year=None, to_year=None,  # noqa: A002
           limit: int | None = None) -> DataFrame:
    """Price index by type and month, optional type match (V3)."""
    df = _years(gold, from_year, to_year)
    kind = clean_text(type, TYPE_EXTRA_CHARS)
    if kind:
        df = df.filter(contains_ci("type_of_residential_property", kind))
    return _top(df.select(*PRICES_COLUMNS)
                .orderBy("year", "month", "type_of_residential_property", "period"), limit)


def sales(gold: DataFrame, from_year=None, to_year=None) -> DataFrame:
    """Yearly sales indicators (V4)."""
    return _years(gold, from_year, to_year).select(*SALES_COLUMNS).orderBy("year")
