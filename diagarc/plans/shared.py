"""Session facts that plans need: the shared folder, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="diagarc-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir()


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark itself would use, so that tasks write where Spark reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.makeQualified(hadoop_path).toString()


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def freeze(df):
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor tasks, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="diagarc-py-"), "diagarc.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
