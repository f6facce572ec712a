"""Session settings and the shared scratch area.

Nothing here holds a global session: every public function of the library
takes the ``SparkSession`` (or a DataFrame) it works on.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library expects.  ANSI stays on (Spark 4 default),
# so bad text is handled with try_* functions rather than silent casts.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """Session for tests, the bench and local runs (``local[cores]``).

    On a cluster build the session with the cluster's own settings and
    apply :data:`SESSION_CONF`; the library never calls ``master()`` there.
    """
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only when unset.

    A cluster sets ``spark.checkpoint.dir`` to shared storage and that value
    is always used.  Only a local session (tests, local runs) without it gets
    a fresh folder under the local temp directory, removed at exit; any other
    session without it is refused, as its executors share no local folder.
    """
    found = checkpoint_dir(spark)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint folder for one run.

    Used for round trips (write then read back) and for cutting lineage with
    a written table; never a machine-local path on a cluster.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


_scratch: list[str] = []  # folders this process has named


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on whatever store, without a failed read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this process; results that still read them end here.

    Call it when the frames an operator returned have been written.  Returns how many
    folders were named.
    """
    n = len(_scratch)
    while _scratch:
        remove_path(spark, _scratch.pop())
    return n
