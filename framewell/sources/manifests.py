"""Versions told by small tables that are written last."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def written_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the folders ``v<number>`` that were written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(folder)):
        return []
    done = []
    for status in fs.listStatus(path(folder)):
        name = status.getPath().getName()
        if re.fullmatch(r"v\d+", name) and fs.exists(path(status.getPath(), "_SUCCESS")):
            done.append(int(name[1:]))
    return sorted(done)


def version_folder(folder: str, number: int) -> str:
    return f"{folder}/v{number:08d}"
