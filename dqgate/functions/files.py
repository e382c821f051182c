"""Folders by the file system of their path: listing names and deleting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Name:
    name: str
    path: str
    modified_ms: int


def _on(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[Name]:
    """What is directly in the folder ``path``, by name; nothing if there is no such folder."""
    system, where = _on(spark, path)
    if not system.exists(where):
        return []
    found = [Name(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in system.listStatus(where)]
    return sorted(found, key=lambda n: n.name)


def delete(spark: SparkSession, path: str) -> None:
    """Remove the folder ``path`` and all in it, if it is there."""
    system, where = _on(spark, path)
    system.delete(where, True)
