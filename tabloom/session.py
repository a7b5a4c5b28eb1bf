"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

PARALLEL_FITS = 4


def local_session(cores: str = "8", app: str = "tabloom") -> SparkSession:
    """A session for tests and the bench; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder is lost
    with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = context.getCheckpointDir() or tempfile.mkdtemp(prefix="tabloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def in_parallel(spark: SparkSession, tasks: Sequence[Callable]) -> list:
    """Run independent fits side by side, as Spark's own cross validator does."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=min(PARALLEL_FITS, max(len(tasks), 1))) as pool:
        running = [pool.submit(inherit(task)) for task in tasks]
        return [r.result() for r in running]
