"""Data-quality metrics and snapshot de-duplication.

Counts are taken with ``DataFrame.observe`` on the action that already
runs (usually the write), never with extra ``count()`` jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def with_metrics(df: DataFrame, checks: dict[str, Column],
                 name: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach named aggregate checks; read them after the next action.

    Example: ``with_metrics(df, {"rows": F.count(F.lit(1)),
    "null_years": null_count("year")})``.
    """
    obs = Observation(name) if name else Observation()
    return df.observe(obs, *[c.alias(k) for k, c in checks.items()]), obs


def null_count(col: str) -> Column:
    """Rows where ``col`` is null."""
    return F.count_if(F.col(col).isNull())


def drop_nulls_observed(df: DataFrame, col: str,
                        name: str | None = None) -> tuple[DataFrame, Observation]:
    """Keep rows with ``col`` set; observe rows before and rows dropped.

    ``dropped_pct`` is derived from the two counts after the action.
    """
    observed, obs = with_metrics(df, {"rows_in": F.count(F.lit(1)),
                                      "rows_dropped": null_count(col)}, name)
    return observed.filter(F.col(col).isNotNull()), obs


def dropped_pct(metrics: dict) -> float:
    """Percentage of rows dropped from an observation of :func:`drop_nulls_observed`."""
    rows = metrics.get("rows_in") or 0
    return 100.0 * (metrics.get("rows_dropped") or 0) / rows if rows else 0.0


def latest_snapshot(df: DataFrame, keys: list[str], snapshot_col: str) -> DataFrame:
    """Rows of the newest snapshot of each ``keys`` group only.

    The newest snapshot per group comes from a plain aggregate (one row per
    group), then a left-semi join keeps the matching rows.  Unlike a
    ``row_number`` window, no group's rows are ever gathered in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(snapshot_col).alias(snapshot_col))
    return df.join(newest, on=[*keys, snapshot_col], how="left_semi")


# A landing time in a file name: yyyymmdd, optionally with a time of day.
STAMP = r"[_-]?((?:19|20)[0-9]{6})(?:[T_-]?([0-9]{6}))?(?=[^0-9/]*$)"
LANDING_FOLDERS = ("year", "month", "day")


def landing_key(path: Column, folders: tuple[str, ...] = LANDING_FOLDERS) -> Column:
    """When a file was landed: its numbered ``folders`` and the time stamp in its name.

    A struct of numbers, so ``month=9`` is older than ``month=10``; null when
    the path holds neither.  ``folders`` are the partition folders that tell
    the *landing* time (none where ``year=`` means the data's own year).
    """
    number = lambda text: F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    parts = [number(F.regexp_extract(path, rf"/{f}=([^/]+)/", 1)).alias(f) for f in folders]
    name = F.element_at(F.split(path, "/"), -1)
    parts += [number(F.regexp_extract(name, STAMP, k)).alias(f"stamp{k}") for k in (1, 2)]
    return F.when(F.coalesce(*[p.cast("bigint") for p in parts]).isNotNull(), F.struct(*parts))


def dataset_key(path: Column, folders: tuple[str, ...] = LANDING_FOLDERS) -> Column:
    """Which dataset a landed file belongs to: its path without the landing time.

    The part files of one Spark write share their folder and so one dataset.
    """
    out = F.regexp_replace(path, r"/part-[^/]*$", "/part")
    if folders:
        out = F.regexp_replace(out, rf"/(?:{'|'.join(folders)})=[^/]*(?=/)", "")
    return F.regexp_replace(out, STAMP, "")


def mark_superseded(files: DataFrame, path_col: str = "path",
                    folders: tuple[str, ...] = LANDING_FOLDERS) -> DataFrame:
    """``files`` plus ``superseded``: a newer landing of the same dataset exists.

    Every file of a dataset's newest landing stays; so does every file whose
    landing time cannot be told.  One aggregate per dataset and a join back.
    """
    keyed = files.withColumns({"_dataset": dataset_key(F.col(path_col), folders),
                               "_landed": landing_key(F.col(path_col), folders)})
    newest = keyed.groupBy("_dataset").agg(F.max("_landed").alias("_newest"))
    return (keyed.join(newest, "_dataset")
            .withColumn("superseded", F.coalesce(F.col("_landed") < F.col("_newest"), F.lit(False)))
            .drop("_dataset", "_landed", "_newest"))


def keep_latest_files(df: DataFrame, path_col: str = "path",
                      folders: tuple[str, ...] = LANDING_FOLDERS) -> DataFrame:
    """Rows whose file (``path_col``) belongs to its dataset's newest landing."""
    files = df.select(F.col(path_col).alias("_file")).distinct()
    old = mark_superseded(files, "_file", folders).filter("superseded").select("_file")
    return df.join(old, F.col(path_col) == F.col("_file"), "left_anti")
