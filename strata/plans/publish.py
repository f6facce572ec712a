"""Publishing marts without a gap, and refreshing only the years that changed (K1, K3).

A static overwrite deletes the old files before it writes the new, and dropping and
recreating a table leaves a moment without it.  Here every run writes a new *version*, a
table of its own, and readers see a view whose definition is replaced in one catalog
operation once the version is complete.  A run that fails leaves the view, and all its
rows, as they were.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.sinks import write_partitioned
from strata.session import path_exists, remove_path

# -- versions and the view ---------------------------------------------------------------


def _versions(spark: SparkSession, db: str, name: str) -> list[str]:
    """Version tables of ``name``, oldest first (their names begin with the time of writing)."""
    found = spark.sql(f"SHOW TABLES IN `{db}` LIKE '{name}__v*'").collect()
    return sorted(r["tableName"] for r in found if not r["isTemporary"])


def write_version(df: DataFrame, db: str, name: str, by: list[str] | tuple[str, ...] = ("year",)) -> str:
    """Write ``df`` as a new version table of ``name``; readers do not see it yet."""
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    out = df.hint("rebalance", *by).sortWithinPartitions(*by)
    out.write.partitionBy(*by).format("parquet").saveAsTable(f"`{db}`.`{version}`")
    return version


def switch(spark: SparkSession, db: str, name: str, version: str) -> None:
    """Show readers of the view ``name`` the rows of ``version``: one catalog operation."""
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{name}` AS SELECT * FROM `{db}`.`{version}`")


def current_version(spark: SparkSession, db: str, name: str) -> str | None:
    """The version table that the view shows, or none."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{name}`").collect()
    except AnalysisException as exc:
        if "TABLE_OR_VIEW_NOT_FOUND" in str(exc):
            return None
        raise
    text = next((r["data_type"] for r in rows if r["col_name"] == "View Text"), "")
    return next((v for v in _versions(spark, db, name) if f"`{v}`" in text), None)


def retire(spark: SparkSession, db: str, name: str, keep: int = 2) -> list[str]:
    """Drop versions older than the current one but for the newest ``keep - 1`` of them, so that
    queries that began before the switch can end.  Returns the names dropped."""
    now = current_version(spark, db, name)
    older = [v for v in _versions(spark, db, name) if now is not None and v < now]
    gone = older[:max(len(older) - (keep - 1), 0)]
    for v in gone:
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{v}`")
    return gone


def publish(df: DataFrame, db: str, name: str, by: list[str] | tuple[str, ...] = ("year",), keep: int = 2) -> str:
    """Write ``df`` as a new version, switch the view ``name`` to it, retire old ones (K1, K3).

    The view has the version's columns and types; year filters prune its partitions.  A
    failed write raises and changes nothing for readers; its half-written table is older
    than the next version and goes with the next :func:`retire`.  A *table* of that name
    must be dropped by hand once.
    """
    spark = df.sparkSession
    version = write_version(df, db, name, by)
    switch(spark, db, name, version)
    retire(spark, db, name, keep)
    return version


def publish_together(frames: dict[str, DataFrame], spark: SparkSession, db: str, by: list[str] | tuple[str, ...] = ("year",),
                     keep: int = 2, then: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None) -> dict[str, str]:
    """Publish several marts: all are written before any is switched.

    ``then`` makes further marts from the written versions of the first ones.
    """
    versions = {name: write_version(df, db, name, by) for name, df in frames.items()}
    if then:
        written = {name: spark.table(f"`{db}`.`{version}`") for name, version in versions.items()}
        versions.update({name: write_version(df, db, name, by) for name, df in then(written).items()})
    for name, version in versions.items():
        switch(spark, db, name, version)
    for name in versions:
        retire(spark, db, name, keep)
    return versions


# -- refresh of changed years ------------------------------------------------------------

def fingerprints(df: DataFrame, by: str = "year") -> DataFrame:
    """One row per ``by``: ``n`` and two sums that depend on the rows but not on their order.

    Sums of hash halves, so that repeated rows count and partial sums combine; a partial
    aggregate sends one row per task and year.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
    a, b = (F.xxhash64(F.lit(salt), *cols) for salt in (1, 2))
    sums = [F.sum(x).alias(f"h{i}") for i, x in enumerate((low(a), F.shiftrightunsigned(a, 32), low(b), F.shiftrightunsigned(b, 32)))]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *sums)


def _beside(path: str, what: str) -> str:
    return f"{path.rstrip('/')}__{what}"


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def changed(new: DataFrame, old: DataFrame | None, by: str = "year") -> tuple[list, list]:
    """Values of ``by`` whose fingerprint is new or differs, and those that are gone.

    Compares one small row per year; the lists hold years only.
    """
    if old is None:
        return sorted((r[0] for r in new.select(by).collect()), key=_null_first), []
    marks = [c for c in new.columns if c != by]
    a = new.select(F.col(by), F.struct(*marks).alias("_new"))
    b = old.select(F.col(by).alias("_by"), F.struct(*marks).alias("_old"))
    both = a.join(b, F.col(by).eqNullSafe(F.col("_by")), "full").filter(~F.col("_new").eqNullSafe(F.col("_old")))
    rows = both.select(by, "_by", F.col("_new").isNull().alias("gone")).collect()
    return (sorted((r[by] for r in rows if not r["gone"]), key=_null_first), sorted((r["_by"] for r in rows if r["gone"]), key=_null_first))


def _null_first(v):
    return (v is not None, v)


def is_one_of(by: str, years: list):
    hit = F.col(by).isin([y for y in years if y is not None])
    return hit | F.col(by).isNull() if None in years else hit


def write_marked(df: DataFrame, path: str, by: str = "year", sort_by: tuple[str, ...] = ()) -> None:
    """Partitioned overwrite that stores each year's fingerprint beside the table."""
    spark, marks = df.sparkSession, _beside(path, "fingerprints")
    _forget(spark, marks, None, by)
    write_partitioned(df, path, (by,), sort_by)
    _store(fingerprints(spark.read.parquet(path), by), marks)


def refresh_table(df: DataFrame, path: str, by: str = "year", ignore: tuple[str, ...] = (),
                  checks: dict | None = None) -> dict[str, list]:
    """Bring the table at ``path`` to the rows of ``df``, rewriting only years that differ (K1).

    ``df`` is written once beside the table, its fingerprints compared with the stored
    ones, and the changed years copied over with a dynamic overwrite.  A year that ``df`` no
    longer holds makes it a full rewrite, as no overwrite removes a folder.  Fingerprints of
    years about to be rewritten are taken off first, so that a run that dies half-way leaves
    them to the next one.  Columns in ``ignore`` (a run's date, say) do not make rows differ;
    a year that is left alone keeps their old values.  ``checks`` are observed on the first
    write and returned as ``observed``.
    """
    spark, stored = df.sparkSession, _beside(path, "fingerprints")
    staged = f"{_beside(path, 'staged')}-{uuid.uuid4().hex[:8]}"
    observed = write_partitioned(df, staged, (by,), checks=checks)
    rows = spark.read.schema(df.schema).parquet(staged)
    marks = fingerprints(rows.drop(*ignore), by)
    old = _read_or_none(spark, stored)
    new, gone = changed(marks, old, by)
    if old is None or gone:
        new = sorted((r[0] for r in marks.select(by).collect()), key=_null_first)
        _forget(spark, stored, None, by)
        write_partitioned(rows, path, (by,))
    elif new:
        _forget(spark, stored, new, by)
        _overwrite_years(rows.filter(is_one_of(by, new)), path, by)
    if old is None or gone or new:
        _store(marks, stored)
    remove_path(spark, staged)
    return {"rewritten": new, "gone": gone, **({"observed": observed.get} if observed else {})}


def _forget(spark: SparkSession, stored: str, years: list | None, by: str) -> None:
    """Take ``years`` (or all) off the stored fingerprints, a row per year."""
    old = _read_or_none(spark, stored)
    if old is not None:
        kept = [] if years is None else [r for r in old.collect() if r[by] not in years]
        _store(spark.createDataFrame(kept, old.schema), stored)


def _overwrite_years(df: DataFrame, path: str, by: str) -> None:
    (df.hint("rebalance", by).sortWithinPartitions(by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def _store(marks: DataFrame, path: str) -> None:
    marks.coalesce(1).write.mode("overwrite").parquet(path)


def refresh_mart(spark: SparkSession, silver: str, gold: str, build: Callable[[DataFrame], DataFrame], by: str = "year",
                 reads_previous: bool = True) -> dict[str, list]:
    """Rebuild the years of the mart at ``gold`` whose Silver rows changed since it was built.

    ``silver`` is a table of :func:`write_marked` or :func:`refresh_table`; its stored
    fingerprints are compared with those the mart was built from, so unchanged years are not
    read at all.  Returns the years ``changed``, ``rebuilt`` and ``read``.
    """
    marks = _read_or_none(spark, _beside(silver, "fingerprints"))
    if marks is None:
        raise ValueError(f"{silver} has no stored fingerprints")
    table = spark.read.parquet(silver)
    return refresh_from(spark, marks, gold, lambda years: build(table if years is None else table.filter(is_one_of(by, years))),
                        by, reads_previous)


def refresh_from(spark: SparkSession, marks: DataFrame, gold: str, build: Callable[[list | None], DataFrame], by: str = "year",
                 reads_previous: bool = True) -> dict[str, list]:
    """Rebuild the years of the mart at ``gold`` whose ``marks`` differ from those it was built from.

    ``build`` is given the years to read (None: all) and returns the mart of these years.
    With ``reads_previous`` the mart compares a year with the one before: then the year after
    each changed one is rebuilt too, and every rebuilt year's predecessor is read.
    """
    built_from = _beside(gold, "built_from")
    before = _read_or_none(spark, built_from)
    new, gone = changed(marks, before, by)
    years = sorted((r[0] for r in marks.select(by).collect()), key=_null_first)
    if before is None or gone:
        _forget(spark, built_from, None, by)
        write_partitioned(build(None), gold, (by,))
        _store(marks, built_from)
        return {"changed": new, "rebuilt": years, "read": years}
    follows = dict(zip(years, years[1:])) if reads_previous else {}
    rebuilt = sorted({*new, *(follows[y] for y in new if y in follows)}, key=_null_first)
    leads = {b: a for a, b in follows.items()}
    read = sorted({*rebuilt, *(leads[y] for y in rebuilt if y in leads)}, key=_null_first)
    if rebuilt:
        _forget(spark, built_from, rebuilt, by)
        _overwrite_years(build(read).filter(is_one_of(by, rebuilt)), gold, by)
        _store(marks, built_from)
    return {"changed": new, "rebuilt": rebuilt, "read": read}


def joint_marks(tables: dict[str, DataFrame], by: str = "year", ignore: tuple[str, ...] = ()) -> DataFrame:
    """One fingerprint per year over several tables, for a mart that joins them."""
    every = None
    for name, df in tables.items():
        own = fingerprints(df.drop(*ignore), by)
        one = own.select(by, F.xxhash64(F.lit(name), *[F.col(c) for c in own.columns if c != by]).alias("h"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("h0"),
                                 F.sum(F.shiftrightunsigned("h", 32)).alias("h1"))
