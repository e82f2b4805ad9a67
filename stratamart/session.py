"""Session settings the library relies on, and its shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

# Settable on a running session. Amounts of shuffle partitions, memory and
# executors stay with the cluster: AQE coalesces and splits from what it is given.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


Result = TypeVar("Result")


def side_by_side(jobs: Sequence[Callable[[], Result]]) -> list[Result]:
    """Submit independent Spark jobs at once, so that small ones fill idle executors.

    Results come in the order of the jobs; the first failure is raised.
    """
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "stratamart", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder of its own. On a cluster a machine-local folder would be unreadable
    for other executors, so the missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="stratamart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
