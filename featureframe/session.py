"""The session and the shared folder jobs leave intermediate results in."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def active_session(spark: SparkSession | None = None) -> SparkSession:
    """The session of a read, whose workers get this package."""
    session = spark or SparkSession.getActiveSession()
    if session is None:
        raise RuntimeError("No active SparkSession; pass one with spark=.")
    ship_package(session)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where a session names none (local runs, tests) a fresh temporary folder is
    set, which only works while all tasks run on this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
            named = tempfile.mkdtemp(prefix="featureframe-")
        context.setCheckpointDir(named)
    # Spark keeps its own checkpoints in a subfolder with a random name
    return plain_path(context.getCheckpointDir())


def new_shared_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder not used before, below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Run a metadata job once and keep its rows in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def metadata_tasks(spark: SparkSession) -> int:
    """Most tasks a job over file names takes.

    Spark packs a file listing by file size, so a job that only looks at names or
    headers of a large folder would get as many tasks as one that reads it all.
    """
    return max(1000, 4 * spark.sparkContext.defaultParallelism)


def plain_path(uri: str) -> str:
    """``file:/a/b`` -> ``/a/b``; other schemes stay."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once per application.

    Not needed where the package is installed on the executors or passed with ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="featureframe-"), "featureframe")
        spark.sparkContext.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        )
        _shipped.add(application)
