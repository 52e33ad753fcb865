"""Where intermediate tables go: the folder shared by the whole cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession

# On a cluster a path of the local file system is taken without a trial when this is "true",
# which says that it is a mount every machine shares.
SHARED_MOUNT = "spark.tallylake.sharedMount"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TRIED: dict[tuple[str, str], bool] = {}  # by application and folder


def _folders(spark: SparkSession) -> list[str]:
    """The folder named by ``spark.checkpoint.dir``, if it is set, then one in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    inside = warehouse and f"{warehouse.rstrip('/')}/_intermediate"
    return [folder.rstrip("/") for folder in (named, inside) if folder]


def _sure(spark: SparkSession, folder: str) -> bool:
    """Whether the settings alone tell that every machine can reach a folder."""
    local_session = spark.conf.get("spark.master", "").startswith("local")
    local_path = folder.startswith(("file:", "/")) or "://" not in folder
    return local_session or not local_path or spark.conf.get(SHARED_MOUNT, "false") == "true"


def _refused(*folders: str) -> RuntimeError:
    return RuntimeError(
        f"{', '.join(folders)}: on the local file system; set spark.checkpoint.dir to a folder every executor "
        f"can reach and write in, or {SHARED_MOUNT}=true if it is a shared mount"
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the session's warehouse.

    In local mode any folder will do. On a cluster a path on the local file system
    may exist on one machine only, so settings alone don't make it the shared folder unless they
    declare it a shared mount; :func:`session_folder` puts it to a trial.
    """
    folder = _folders(spark)[0]
    if not _sure(spark, folder):
        raise _refused(folder)
    return folder


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what the executors write in ``folder`` is seen by the driver and by one another.

    Some tasks a core each write a row. The driver publishes and lists only files that it sees, and in the reading,
    an executor that doesn't see a listed file fails. An executor that starts later is not tried.
    """
    path = f"{folder}/shared-{uuid.uuid4().hex}"
    tasks = 4 * max(1, spark.sparkContext.defaultParallelism)
    try:
        try:
            rows = spark.range(0, tasks, 1, tasks)
            rows.write.parquet(path)
            found = spark.read.schema(rows.schema).parquet(path).agg({"id": "sum"}).first()[0]
            return found == tasks * (tasks - 1) // 2
        finally:
            discard(spark, path)
    except (CapturedException, Py4JJavaError):  # a write, read or removal that failed is the answer
        return False


def session_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application alone.

    On a cluster, a local path that isn't declared shared is tried once in an application. Where the named folder
    fails, as one that the executors may not write in, the warehouse is next; an error if that fails too.
    """
    application = spark.sparkContext.applicationId
    folders = _folders(spark)
    for folder in folders:
        if not _sure(spark, folder) and (application, folder) not in _TRIED:
            _TRIED[application, folder] = is_shared(spark, folder)
        if _sure(spark, folder) or _TRIED[application, folder]:
            return f"{folder}/{application}"
    raise _refused(*folders)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's folder; nothing else ever writes to it."""
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str | None = None) -> None:
    """Remove an intermediate path, by default all that this application left behind."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or session_folder(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it ends; else they stay until the driver collects its garbage.

    For actions whose results are written or fetched, so nothing reads those files again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
