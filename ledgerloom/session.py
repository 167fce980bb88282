"""Session settings the jobs are written for."""

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def spark_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with runtime re-planning and skew splitting on, and one fixed time zone.

    On a cluster leave ``master`` to spark-submit; ``conf`` overrides any default below.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed join is split even where that costs one more exchange above it.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Layers bucketed by account and month join on account, month and day where they lie.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # Call sites kept per column expression slow the building of wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def single_machine(master: str) -> bool:
    """Whether driver and executors share one machine's folders by being one process: ``local`` and ``local[...]``."""
    return master == "local" or master.startswith("local[")


def local_shared_folder(spark: SparkSession) -> None:
    """Give a local session that has no ``spark.checkpoint.dir`` a temporary one, dropped at exit.

    For entry points on one machine (tests, bench, the driver's smoke run); other sessions are left
    as they are and must bring a folder that all executors share.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or not single_machine(context.master):
        return
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
