"""Folders and small files of tables, by Hadoop's file system, so that any store will do."""

from __future__ import annotations

import json
from collections.abc import Collection

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = located(spark, path)
    return fs.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = located(spark, path)
    fs.delete(folder, True)


def completed(spark: SparkSession, path: str, skip: Collection[str] = ()) -> list[str]:
    """Names of the folders below a path, but for those to skip, whose write has finished."""
    if not table_exists(spark, path):
        return []
    fs, folder = located(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return [n for n in names if n not in skip and table_exists(spark, f"{path}/{n}/_SUCCESS")]


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    if not table_exists(spark, folder):
        return []
    fs, path = located(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return [int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json")]


def newest_note(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The last published note of a folder and its number; 0 and None before the first."""
    number = max(_numbers(spark, folder), default=0)
    if not number:
        return 0, None
    fs, path = located(spark, f"{folder}/v={number}.json")
    stream = fs.open(path)
    try:
        return number, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_note(spark: SparkSession, folder: str, number: int, note: dict) -> None:
    """Write a note beside the others and give it its number by a rename: readers see all of it or nothing."""
    name = f"{folder}/v={number}.json"
    fs, path = located(spark, name)
    _, draft = located(spark, f"{name}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(note).encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(draft, path):
        raise RuntimeError(f"cannot publish {name}: another writer has done so")


def expire_notes(spark: SparkSession, folder: str) -> None:
    """Delete all notes but the newest."""
    for number in sorted(_numbers(spark, folder))[:-1]:
        remove(spark, f"{folder}/v={number}.json")
