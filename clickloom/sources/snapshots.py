"""Newest-snapshot source."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SUFFIX = r"([\d-]+)$"


def list_snapshots(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Paths named ``prefix`` plus digits and dashes, newest suffix first.

    Only names are listed, through the file system that holds the folder.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    named = re.compile(re.escape(prefix) + SUFFIX)
    found = []
    for status in fs.listStatus(path):
        match = named.fullmatch(status.getPath().getName())
        if match:
            found.append((match.group(1), status.getPath().toString()))
    return [p for _, p in sorted(found, reverse=True)]


def newest_snapshot(spark: SparkSession, folder: str, prefix: str) -> str:
    snapshots = list_snapshots(spark, folder, prefix)
    if not snapshots:
        raise FileNotFoundError(f"no snapshot {prefix}* in {folder}")
    return snapshots[0]


def read_newest(spark: SparkSession, folder: str, prefix: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(newest_snapshot(spark, folder, prefix))
