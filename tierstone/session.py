"""Session and scratch-space helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "tierstone", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system its path names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def shared_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables a query writes and reads back.

    Lies under ``spark.checkpoint.dir``, which a cluster points at shared storage;
    a temporary folder stands in only where that is unset, as in local tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = _local_scratch()
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = files.makeQualified(hadoop_path).toString()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tierstone-")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application.

    Needed where the driver finds it by its own path only, as in a checkout that is not
    installed on the machines of the cluster.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:  # all sessions of an application share its files
        _SHIPPED[application] = _ship(spark, application)


_SHIPPED: dict[str, str] = {}


def _ship(spark: SparkSession, application: str) -> str:
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tierstone-code-")) / f"{root.name}-{application}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    return str(target)
