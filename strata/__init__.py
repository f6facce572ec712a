"""strata: medallion analytics on Spark.

Bronze (raw documents and CSV files) -> Silver (typed, year-partitioned
Parquet) -> Gold (marts) -> views, all as DataFrame jobs.

* ``strata.sources``    document scans, file listing, header-grouped CSV reads,
                        raw landing and the load manifest
* ``strata.operators``  JSON-stat cube unpack, grouped statistics, pivots,
                        year-on-year change, key spines, quality metrics
* ``strata.functions``  column-name rules, scalar column functions, coercion
* ``strata.plans``      Silver and Gold builders, views, sinks/catalog, the two
                        batch jobs, and the analog queries with their oracles
* ``strata.streaming``  the incremental (available-now) cube -> Silver step
"""
