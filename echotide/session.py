"""Session settings the library relies on, and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two; everything else is the cluster's choice.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on. Safe to call repeatedly."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a fresh folder, because a
    machine-local folder would not survive the loss of an executor on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="echotide-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, place: str, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a new folder under ``place`` and read back, and that folder.

    A fan-out then neither recomputes it nor depends on the executors that computed it, and each
    branch reads only its columns. ``place`` must be shared by all executors; the caller removes
    the folder with ``drop_folder``.
    """
    spark = df.sparkSession
    path = f"{place}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, through the file system it lies in."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, in whatever file system it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
