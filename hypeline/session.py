"""Session construction and the shared scratch location.

Writers that must cut lineage or stage data before a rewrite use a folder
below ``spark.checkpoint.dir`` -- the shared, cluster-visible folder the
deployment names.  Only when that setting is absent (local tests) do we
create one, once per session.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "hypeline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on.

    UTC session time is mandatory: every DATE(ts) and interval boundary in
    the models is defined in UTC.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or an explicit
    ``setCheckpointDir``).  Only where neither is set -- local tests -- a
    temporary folder is created, once per application."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _ROOTS:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster; "
                                   "staged tables must survive lost executors")
            root = tempfile.mkdtemp(prefix="hypeline-ckpt-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        _ROOTS[app] = root
    return _ROOTS[app]


_SCRATCH: ContextVar["list[str] | None"] = ContextVar("_SCRATCH", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/hypeline/{name}-{uuid.uuid4().hex[:12]}"
    if (names := _SCRATCH.get()) is not None:
        names.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every scratch folder that was named inside: the copies
    that a step made for itself, once its table is written."""
    token = _SCRATCH.set(names := [])
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in names:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Have Spark drop the shuffle files of a query when it ends.  They would
    otherwise stay until the driver happens to collect its garbage, those of
    all steps of a run beside each other.  For steps that write a table and run no
    DataFrame twice (that would shuffle again)."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


__all__ = ["get_spark", "checkpoint_root", "scratch_path", "scratch_scope", "shuffles_dropped"]
