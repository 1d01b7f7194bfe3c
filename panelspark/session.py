"""Session helpers and the shared scratch area.

All intermediate tables (landed raw files, published tables, streaming
checkpoints) live under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (unit tests,
a laptop) do we create a private temporary folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Sessions that have the settings of panels: how many callers ask for them now, and the settings before the first.
_DROPPING: dict[SparkSession, tuple[int, dict[str, str | None]]] = {}
_DROP_LOCK = threading.Lock()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "panelspark") -> SparkSession:
    """Session used by tests and the bench; production jobs bring their own."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """Root of the shared scratch area (``spark.checkpoint.dir``)."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        # Unset only on a single machine (tests, local runs): register a
        # private folder so checkpoint() and our tables share one root.
        local = tempfile.mkdtemp(prefix="panelspark-")
        spark.sparkContext.setCheckpointDir(os.path.join(local, "_checkpoints"))
        _LOCAL_ROOTS[app] = local
    return _LOCAL_ROOTS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: What panels set while they land and are built. Spark removes the shuffle files of a query when the query ends, not when
#: the driver's heap is cleared. A generated method above 8000 bytes of code (80 months or 10 metrics in a projection) is
#: one that the JVM never compiles: such a stage runs by operator instead, whose projections are cut into small methods.
PANEL_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, the session has ``PANEL_SETTINGS``.

    Callers in several threads may overlap: the last to leave restores the session's settings."""
    with _DROP_LOCK:
        n, before = _DROPPING.get(spark, (0, {key: spark.conf.get(key, None) for key in PANEL_SETTINGS}))
        _DROPPING[spark] = n + 1, before
        for key, value in PANEL_SETTINGS.items():
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _DROP_LOCK:
            n, before = _DROPPING.pop(spark)
            if n > 1:
                _DROPPING[spark] = n - 1, before
            for key, value in before.items() if n == 1 else ():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
