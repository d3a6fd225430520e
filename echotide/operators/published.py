"""One publication of the three tables of a star: readers see a whole version or the one before.

Every version lies in a folder of its own that never changes. Only once all three tables are written
does a row in the table ``manifests`` name that folder, with the rows of each table as the writes
themselves counted them. The row is one file, which appears at once or not at all. A failure at any
point before leaves the last version as it was; its unfinished folder is removed. Reading takes the
newest named version, and goes on in it while later ones are published.

One publisher at a time may work on a path; any number of readers may.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_folder, folder_exists
from . import star

MANIFEST = "version bigint, folder string, n_rows map<string, bigint>"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, folder, n_rows`` (rows of each table) of all publications; no rows before the
    first."""
    manifests = f"{path}/manifests"
    if not folder_exists(spark, manifests):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(manifests)


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest publication, from 1; None before the first."""
    return versions(spark, path).agg(F.max("version")).first()[0]


def publish_star(
    base: DataFrame, path: str, staging: str, order: str | Column = "arrival"
) -> int:
    """Write the star over ``base`` as the next version under ``path`` and return its number.
    ``path`` and ``staging`` are places that all executors share."""
    spark = base.sparkSession
    version = (latest_version(spark, path) or 0) + 1
    folder = f"versions/{version}-{uuid.uuid4().hex}"
    try:
        n_rows = star.write_star(base, f"{path}/{folder}", staging, order)
    except BaseException:
        drop_folder(spark, f"{path}/{folder}")
        raise
    named = spark.createDataFrame([(version, folder, n_rows)], MANIFEST)
    named.coalesce(1).write.mode("append").json(f"{path}/manifests")
    return version


def read_published(
    spark: SparkSession, path: str, version: int | None = None
) -> dict[str, DataFrame]:
    """The tables of one version, the newest if none is given."""
    known = versions(spark, path)
    if version is not None:
        known = known.filter(F.col("version") == version)
    row = known.orderBy(F.desc("version"), "folder").first()
    if row is None:
        raise ValueError(f"no version {version or ''} of a star under {path}")
    return star.read_star(spark, f"{path}/{row['folder']}")


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the tables of all but the newest ``keep`` versions, and return those removed now.
    Their rows in ``manifests`` stay. Readers still in one of them fail, so ``keep`` should cover the
    longest read."""
    if keep < 1:
        raise ValueError("at least the newest version stays")
    newest = latest_version(spark, path) or 0
    old = versions(spark, path).filter(F.col("version") <= newest - keep).collect()
    gone = [row for row in old if folder_exists(spark, f"{path}/{row['folder']}")]
    for row in gone:
        drop_folder(spark, f"{path}/{row['folder']}")
    return sorted(row["version"] for row in gone)
