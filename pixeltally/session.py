"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that results depend on.
DECISIVE = ["spark.sql.ansi.enabled", "spark.sql.session.timeZone"]

_scratch_roots: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch folders to remove", default=None)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pixeltally")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may go without that setting; it then gets a fresh
    folder of its own, since its driver and executors share one file system.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _scratch_roots:
        _scratch_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _scratch_roots[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other call gets."""
    folder = f"{scratch_root(spark)}/pixeltally-{uuid.uuid4().hex}"
    if (folders := _scope.get()) is not None:
        folders.append(folder)
    return f"{folder}/{name}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made within are removed at its end, also if it fails.

    For work that ends in a write: a DataFrame that reads such a folder must not outlive it.
    """
    token = _scope.set([])
    try:
        yield
    finally:
        folders = _scope.get() or []
        _scope.reset(token)
        for folder in folders:
            path, file_system = hadoop_path(spark, folder)
            file_system.delete(path, True)


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop's path object and its file system, whatever store the path is in."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def require_settings(spark: SparkSession) -> None:
    """Raise if the session has other settings than results rely on."""
    wrong = {k: v for k in DECISIVE if (v := spark.conf.get(k)).lower() != SETTINGS[k].lower()}
    if wrong:
        raise RuntimeError(f"set {({k: SETTINGS[k] for k in wrong})}; the session has {wrong}")
