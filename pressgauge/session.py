"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "pressgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the cluster's own values win elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, so that they find it whatever folder they start in.

    Nothing is sent where the package was itself submitted as a zip.
    """
    application, package = spark.sparkContext.applicationId, os.path.dirname(os.path.abspath(__file__))
    if application in _SHIPPED or not os.path.isdir(package):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="pressgauge-"), os.path.basename(package))
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(application)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def work_dir(spark: SparkSession) -> str:
    """The folder under the shared one that holds everything this application keeps for itself."""
    return os.path.join(shared_dir(spark), f"pressgauge-{spark.sparkContext.applicationId}")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the application's work folder, unused by any other run."""
    return os.path.join(work_dir(spark), f"{label}-{uuid.uuid4().hex}")


def clear_work(spark: SparkSession) -> None:
    """Remove the application's work folder; frames that still read from it must have been written elsewhere."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
