"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every job of this package is designed for. Shuffle width is left to the deployment: AQE
# coalesces small partitions, and splits skewed join partitions (forced, so that a split is taken
# even where it costs one more exchange downstream).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode, and the rules of a table of some
    # twenty columns make one: five times slower. Above this limit Spark splits the code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    # Call-site capture costs a round trip to the JVM for every Column; rules make many Columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app: str = "medallion", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package defaults; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """The same settings on a session made elsewhere, as far as a running session takes them."""
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what is planned meanwhile."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def workspace(spark: SparkSession, label: str = "run") -> str:
    """A new folder for tables a job writes, under the cluster's shared `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder: on a cluster that would be one
    machine's own disk, which other executors cannot read and which is lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/medallion/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"medallion-{label}-")


def run_parallel(
    spark: SparkSession, work: Callable[[str], None], names: Iterable[str], parallel: int
) -> None:
    """Independent jobs side by side, so that small tables do not leave the cluster idle in turn.

    Local properties of the caller (job group, scheduler pool) reach every thread. The first failure
    is raised.
    """
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), names))
