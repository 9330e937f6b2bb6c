"""Session settings and the shared folder every job may write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "paperloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="paperloom-", dir="/tmp")
    return _local_roots[context.applicationId]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared folder.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session, whose
    tasks all see the driver's disk, may go without it.
    """
    return f"{_shared_root(spark)}/paperloom/{purpose}-{uuid.uuid4().hex}"


_scratch: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Scratch tables made inside are dropped at the end, also after a failure.

    What leaves the scope must be written elsewhere. Scopes nest: each drops its own tables.
    """
    made: list[tuple[SparkSession, str]] = []
    before = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(before)
        for spark, path in made:
            drop_scratch(spark, path)


def scoped(job: Callable) -> Callable:
    """A job whose result is written tables or plain values: its scratch tables go when it ends."""

    @wraps(job)
    def run(*args, **options):
        with scratch_scope():
            return job(*args, **options)

    return run


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder that the surrounding scope, if any, drops at its end."""
    path = shared_dir(spark, purpose)
    made = _scratch.get()
    if made is not None:
        made.append((spark, path))
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table made below the shared folder, once nothing reads it any more."""
    if not path.startswith(f"{_shared_root(spark)}/paperloom/"):
        raise ValueError(f"{path} is not a scratch table of this session")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Fixed value: files of a partitioned write that one task keeps open.
OPEN_WRITERS = 64


@contextmanager
def open_writers(spark: SparkSession, files: int = OPEN_WRITERS) -> Iterator[None]:
    """Partitioned writes inside keep a file open per folder, so their rows need no sort; with more folders the rest is sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where two branches of a plan need the same costly result. The table outlives
    lost executors, and later scans of it prune columns and push filters down. A
    ``scratch_scope`` around the call drops it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
