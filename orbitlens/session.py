"""Session construction and cluster-level settings.

The library itself never creates a session inside an operator; callers pass
their own.  ``get_session`` is the convenience used by the bench, the tests
and the streaming examples.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                app_name: str = "orbitlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every pipeline relies on.

    * UTC session time zone: all epoch arithmetic is done in UTC.
    * AQE with partition coalescing and skew-join splitting, so a series that
      holds a large share of the rows does not pin a single reducer.
    * Arrow for the few pandas-backed operators.
    * No web UI (nothing listens on a port besides Spark's own RPC).
    """
    master = master or os.environ.get("ORBITLENS_MASTER", "local[*]")
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .config("spark.driver.memory", os.environ.get("ORBITLENS_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()
_ZIP: str | None = None


def ship_package(spark: SparkSession) -> None:
    """Make ``orbitlens`` importable in the Python workers of this application.

    Pandas functions (forest, peak finding, block solvers) are pickled with
    references to this package; executors do not share the driver's
    ``sys.path``, so the package is zipped once per process and added with
    ``SparkContext.addPyFile`` once per application (Spark distributes it to
    every executor, including ones started later).  A cluster that installs
    the package in its images needs none of this; it is harmless there.
    """
    global _ZIP
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if _ZIP is None:
        import zipfile
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        fd, path = tempfile.mkstemp(prefix="orbitlens-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.relpath(full, root))
        _ZIP = path
    sc.addPyFile(_ZIP)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (the setting the cluster provides).
    Where it is unset, a local master gets a fresh scratch folder; on a cluster
    that folder would be one machine's own, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="orbitlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
