"""Bronze -> Silver builders.

Each builder returns lazy DataFrames; the caller's write is the one action.
Row counts and null audits ride on that action through ``observe``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import (CSV_NAME_BLANKS, RENT_MONEY_CHARS, RENTS_CODE, SALES_CODE, SALES_COVERAGE,
                                 SALES_HEADER_PATTERNS, SALES_HEADER_SYNONYMS)
from strata.functions.coerce import add_lineage, ensure_year
from strata.functions.names import clean_columns, drop_code_columns
from strata.functions.values import (first_nonblank, first_year, keep_blank_or_no, parse_date,
                                     parse_money, parse_price)
from strata.operators import jsonstat
from strata.operators.quality import drop_nulls_observed
from strata.sources.files import read_csv_by_header

SALES_CANONICAL = sorted(set(SALES_HEADER_SYNONYMS.values()))


def cube_silver(docs: DataFrame, dataset: str, run_date: str,
                columns: list[tuple[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cube documents -> long typed table partitionable by ``year``.

    Returns ``(silver, rejects)``.  ``silver`` has one column per dimension
    (``period`` for the time dimension), ``metric_value`` DOUBLE, lineage
    columns and ``year`` = first 4-digit run of ``period`` (null when the
    cube has no time dimension).  ``rejects`` lists the documents that could
    not be unpacked and why.  See :func:`cube_silver_parsed` to parse once
    and reuse the result for several outputs.
    """
    return cube_silver_parsed(jsonstat.parse(docs.select("path", "body")), dataset, run_date, columns)


def cube_silver_parsed(parsed: DataFrame, dataset: str, run_date: str,
                       columns: list[tuple[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`cube_silver` on the output of :func:`jsonstat.parse`."""
    if columns is None:
        columns = jsonstat.dimension_columns(parsed)
    wide = add_lineage(jsonstat.widen(parsed, columns), dataset, run_date)
    names = [n for _, n in columns]
    year = first_year("period") if "period" in names else F.lit(None).cast("int")
    return wide.withColumn("year", year), jsonstat.rejects(parsed)


def rents_silver(raw: DataFrame, run_date: str, run_year: int) -> DataFrame:
    """Flat cube CSV extract -> typed rents table.

    Code columns go, names are cleaned (CSV variant), ``value`` becomes a
    DOUBLE after removing currency marks, ``year`` comes from the text or
    falls back to the run year.
    """
    df = clean_columns(drop_code_columns(raw), CSV_NAME_BLANKS)
    if "value" in df.columns:
        df = df.withColumn("value", parse_money("value", RENT_MONEY_CHARS))
    df = ensure_year(df, run_year)
    return add_lineage(df, RENTS_CODE, run_date)


def read_sales(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame]:
    """Sales register CSVs (latin-1, differing headers) -> canonical string columns."""
    return read_csv_by_header(spark, path, SALES_HEADER_SYNONYMS, SALES_HEADER_PATTERNS,
                              required=["date_of_sale_raw"], canonical=SALES_CANONICAL)


def sales_silver(raw: DataFrame, run_date: str):
    """Canonical sales rows -> typed sales table.

    Returns ``(silver, observation)``; the observation holds ``rows_in`` and
    ``rows_dropped`` (unparseable dates) once the caller's action has run.
    """
    df = raw.withColumn("location_code", first_nonblank("eircode", "postal_code"))
    df = df.withColumn("price_eur", parse_price("price_raw"))
    df = df.withColumn("date_of_sale", parse_date("date_of_sale_raw"))
    df, obs = drop_nulls_observed(df, "date_of_sale")
    df = df.withColumns({"year": F.year("date_of_sale"), "month": F.month("date_of_sale")})
    df = df.filter(keep_blank_or_no("not_full_market_price"))
    df = df.drop("postal_code", "eircode", "price_raw", "date_of_sale_raw")
    return add_lineage(df, SALES_CODE, run_date, coverage=SALES_COVERAGE), obs
