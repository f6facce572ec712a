"""The two batch jobs: Bronze -> Silver and Silver -> Gold.

Layout (``root`` may be any Hadoop-compatible URI)::

    bronze/cso/house_price_index/**          cube documents, one per line
    bronze/cso/new_dwelling_completions/**
    bronze/rtb/rent_by_county/**             flat cube CSV extract
    bronze/ppr/sales_register/**             yearly latin-1 CSVs, varying headers
    silver/<same paths>/year=YYYY/           typed Parquet
    silver/_rejects/<dataset>/               documents or files set aside, with reason
    gold/<table>/year=YYYY/                  marts, registered in ``database``

Each dataset is one lazy plan and one write; counts ride on the write
through ``observe``.  The summary mart reads the four written Gold tables
back, so its lineage starts at Parquet, not at Bronze.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import CUBE_SOURCES, GOLD_TABLES, SILVER_PATHS
from strata.operators.quality import LANDING_FOLDERS, null_count
from strata.plans import gold
from strata.operators import jsonstat
from strata.plans.publish import is_one_of, joint_marks, publish_together, refresh_from, refresh_mart, refresh_table
from strata.plans.silver import cube_silver_parsed, read_sales, rents_silver, sales_silver
from strata.plans.sinks import ensure_database, register_external, write_partitioned
from strata.sources.documents import read_documents
from strata.sources.files import REJECT_SCHEMA, newest_snapshot_files, read_csv_by_header

# Columns that tell the run, not the data
RUN_COLUMNS = ("ingestion_date", "gold_updated")


def _checks() -> dict:
    return {"rows": F.count(F.lit(1)), "null_years": null_count("year")}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, run_date: str,
                     run_year: int | None = None, latest_only: bool = True,
                     database: str | None = None,
                     database_location: str | None = None, incremental: bool = False) -> dict[str, dict]:
    """Clean the four Bronze sources into year-partitioned Silver Parquet.

    Bronze is append-only, so every monthly run lands another snapshot of
    each source.  With ``latest_only`` (default) every file of each dataset's
    newest landing is read, so re-runs never double sums and counts (D1).  A
    dataset is a file's path without its landing time: the ``year=`` and
    ``month=`` folders (not for the sales register, whose ``year=`` is the
    year of sale) and a time stamp in the name.  The choice is made from the
    file listing, so older files are not scanned; they are listed under
    ``_rejects`` as ``superseded``.

    Returns per-dataset metrics observed on the writes (rows, null years,
    and for sales the rows dropped for unparseable dates).  Sources whose
    folder is missing or holds nothing are skipped, as the source job does.
    With ``database`` each Silver table is also registered (``silver_<name>``).
    ``incremental`` rewrites only the years whose rows differ from the last run's (see
    :func:`strata.plans.publish.refresh_table`) and adds those years as ``rewritten``.
    """
    bronze, silver = bronze.rstrip("/"), silver.rstrip("/")
    run_year = run_year or int(run_date[:4])

    def source(name: str, glob: str = "*", folders: tuple[str, ...] = LANDING_FOLDERS):
        """A source's files to read (its folder if all), and the rejects for those replaced."""
        root = f"{bronze}/{SILVER_PATHS[name]}"
        paths, old = newest_snapshot_files(spark, root, glob, folders) if latest_only else (root, [])
        return paths, spark.createDataFrame([(p, "superseded", None) for p in old], REJECT_SCHEMA)

    def store(name: str, df: DataFrame) -> dict:
        path = f"{silver}/{SILVER_PATHS[name]}"
        if not incremental:
            return write_partitioned(df, path, checks=_checks()).get
        done = refresh_table(df, path, ignore=RUN_COLUMNS, checks=_checks())
        return {**done["observed"], "rewritten": done["rewritten"]}

    def set_aside(name: str, rejects: DataFrame) -> None:
        rejects.write.mode("overwrite").json(f"{silver}/_rejects/{name}")

    def cube(name: str, code: str):
        paths, superseded = source(name)
        docs = read_documents(spark, paths) if paths else None
        if docs is None or docs.isEmpty():
            return None
        # parsed once, used three times (column names, cells, rejects);
        # spills to disk, and lost blocks are recomputed from the files
        parsed = jsonstat.parse(docs.select("path", "body")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            df, rejects = cube_silver_parsed(parsed, code, run_date)
            observed = store(name, df)
            set_aside(name, rejects.select("path", "reason").unionByName(superseded, allowMissingColumns=True))
            return name, observed, df
        finally:
            parsed.unpersist()

    def rents():
        paths, superseded = source("rent_by_county", "*.csv")
        raw, rejected = read_csv_by_header(spark, paths, {}, encoding="UTF-8", file_col=None) if paths else (None, superseded)
        set_aside("rent_by_county", rejected.unionByName(superseded) if paths else superseded)
        if raw is None or not raw.columns:
            return None
        df = rents_silver(raw, run_date, run_year)
        return "rent_by_county", store("rent_by_county", df), df

    def sales():
        paths, superseded = source("sales_register", "*.csv", ())
        raw, rejected = read_sales(spark, paths) if paths else (None, superseded)
        set_aside("sales_register", rejected.unionByName(superseded) if paths else superseded)
        if raw is None:
            return None
        df, dropped = sales_silver(raw, run_date)
        df = df.drop("source_file")
        observed = store("sales_register", df)
        return "sales_register", {**observed, **dropped.get}, df

    # the four sources are independent: their jobs are submitted side by side
    tasks = [(cube, (n, c)) for n, c in CUBE_SOURCES.items()] + [(rents, ()), (sales, ())]
    metrics: dict[str, dict] = {}
    written: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for done in [pool.submit(fn, *args) for fn, args in tasks]:
            result = done.result()
            if result:
                name, observed, df = result
                metrics[name], written[name] = observed, df
    if database:
        ensure_database(spark, database, database_location)
        for name, df in written.items():  # the written frames carry the table schemas
            register_external(spark, database, f"silver_{name}", f"{silver}/{SILVER_PATHS[name]}", df)
    return metrics


def _marts(run_date: str, exact_median: bool) -> dict:
    """Per mart: the Silver table it reads, its builder, and whether it looks back a year."""
    return {
        "price": ("house_price_index", lambda df: gold.price_index(df, run_date), False),
        "rent": ("rent_by_county", lambda df: gold.rent_trends(df, run_date), True),
        "perms": ("new_dwelling_completions", lambda df: gold.permissions_trend(df, run_date), True),
        "sales": ("sales_register", lambda df: gold.property_sales(df, run_date, exact_median=exact_median), True),
    }


def silver_to_gold(spark: SparkSession, silver: str, gold_root: str, run_date: str,
                   database: str | None = None, database_location: str | None = None,
                   summary_options: dict | None = None, exact_median: bool = False) -> dict[str, str]:
    """Build, write and register the five Gold marts; returns table -> path.

    ``summary_options`` are passed to :func:`gold.crisis_summary` (for
    example another ``dublin_needle``); ``exact_median`` to :func:`gold.property_sales`.
    """
    silver, gold_root = silver.rstrip("/"), gold_root.rstrip("/")
    read = lambda name: spark.read.parquet(f"{silver}/{SILVER_PATHS[name]}")
    marts: dict[str, DataFrame] = {key: build(read(name)) for key, (name, build, _) in _marts(run_date, exact_median).items()}
    paths = {key: f"{gold_root}/{GOLD_TABLES[key]}" for key in marts}
    # the four marts read different Silver tables: submit their writes together so
    # their (often small) jobs share the cluster instead of queueing one by one
    with ThreadPoolExecutor(max_workers=len(marts)) as pool:
        for done in [pool.submit(write_partitioned, df, paths[key]) for key, df in marts.items()]:
            done.result()
    written = {k: spark.read.parquet(p) for k, p in paths.items()}
    summary = gold.crisis_summary(written["price"], written["rent"], written["perms"],
                                  written["sales"], run_date, **(summary_options or {}))
    paths["summary"] = f"{gold_root}/{GOLD_TABLES['summary']}"
    write_partitioned(summary, paths["summary"])
    if database:
        ensure_database(spark, database, database_location)
        for key, df in {**marts, "summary": summary}.items():  # schemas of the written frames
            register_external(spark, database, GOLD_TABLES[key], paths[key], df)
    return {GOLD_TABLES[k]: p for k, p in paths.items()}


def publish_gold(spark: SparkSession, silver: str, run_date: str, database: str, database_location: str | None = None,
                 summary_options: dict | None = None, exact_median: bool = False, keep: int = 2) -> dict[str, str]:
    """The five marts as views that never miss a row while they are rebuilt; view -> version table.

    All four marts are written as new versions, then the summary of these versions, and
    only then are the views switched, one catalog operation each.  A run that fails leaves every
    view on its old version.  See :mod:`strata.plans.publish`.
    """
    ensure_database(spark, database, database_location)
    silver = silver.rstrip("/")
    read = lambda name: spark.read.parquet(f"{silver}/{SILVER_PATHS[name]}")
    frames = {GOLD_TABLES[key]: build(read(name)) for key, (name, build, _) in _marts(run_date, exact_median).items()}

    def summary(written: dict[str, DataFrame]) -> dict[str, DataFrame]:
        by_key = {k: written[GOLD_TABLES[k]] for k in ("price", "rent", "perms", "sales")}
        return {GOLD_TABLES["summary"]: gold.crisis_summary(by_key["price"], by_key["rent"], by_key["perms"], by_key["sales"],
                                                            run_date, **(summary_options or {}))}
    return publish_together(frames, spark, database, keep=keep, then=summary)


def refresh_gold(spark: SparkSession, silver: str, gold_root: str, run_date: str, summary_options: dict | None = None,
                 exact_median: bool = False) -> dict[str, dict[str, list]]:
    """Rebuild only the years of the marts whose Silver rows changed (Silver written with
    ``bronze_to_silver(incremental=True)``).

    A mart with a change against the year before is rebuilt for the next year too.  The summary
    follows the years in which any of the four marts now differs from what it was built
    from.  Returns, per mart, the years changed, rebuilt and read.
    """
    silver, gold_root = silver.rstrip("/"), gold_root.rstrip("/")
    paths = {key: f"{gold_root}/{name}" for key, name in GOLD_TABLES.items()}
    marts = _marts(run_date, exact_median)
    out: dict[str, dict[str, list]] = {}
    with ThreadPoolExecutor(max_workers=len(marts)) as pool:
        tasks = {key: pool.submit(refresh_mart, spark, f"{silver}/{SILVER_PATHS[name]}", paths[key], build, "year", back)
                 for key, (name, build, back) in marts.items()}
        for key, done in tasks.items():
            out[GOLD_TABLES[key]] = done.result()
    written = {k: spark.read.parquet(paths[k]) for k in marts}

    def summary(years: list | None) -> DataFrame:
        part = {k: df if years is None else df.filter(is_one_of("year", years)) for k, df in written.items()}
        return gold.crisis_summary(part["price"], part["rent"], part["perms"], part["sales"], run_date, **(summary_options or {}))
    out[GOLD_TABLES["summary"]] = refresh_from(spark, joint_marks(written, ignore=RUN_COLUMNS), paths["summary"], summary,
                                               reads_previous=False)
    return out
