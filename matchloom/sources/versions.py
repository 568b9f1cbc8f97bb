"""Versions of a folder's tables behind one pointer.

Data is written to new folders only and never changed. A version is a small JSON file with a number that tells which folders count; putting the next number is what makes
a write visible, all of it at once. A pointer is created and never replaced, so of two writers that start from one version one fails. No data is renamed, so a
store without renames will do. A reader resolves the newest pointer once and then reads folders that stay as they are until vacuum().
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .landing import _files, write_fact


class Conflict(Exception):
    """Another writer has put the next version."""


def _text(fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _numbers(fs, of, folder: str) -> list[int]:
    """Numbers of the pointers, the newest first."""
    path = of(f"{folder}/_versions")
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)


def current(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, dict]:
    """The newest version (or a given one) and its content; 0 and nothing if there is none. A pointer that is just being written does not count yet."""
    fs, of = _files(spark, folder)
    for n in _numbers(fs, of, folder) if version is None else [version]:
        try:
            return n, json.loads(_text(fs, of(f"{folder}/_versions/{n:010}.json")))
        except ValueError:
            continue
    return 0, {}


def put(spark: SparkSession, folder: str, base: int, content: dict) -> int:
    """Makes `content` the version after base, which must be the newest one."""
    fs, of = _files(spark, folder)
    newest = next(iter(_numbers(fs, of, folder)), 0)
    if newest > base:
        raise Conflict(f"{folder} is at version {newest}, not {base}")
    try:
        stream = fs.create(of(f"{folder}/_versions/{base + 1:010}.json"), False)
    except Exception as e:  # the file system's own error if the file is there
        raise Conflict(f"{folder}: version {base + 1} cannot be put") from e
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    return base + 1


def new_run() -> str:
    return uuid.uuid4().hex


def drop(spark: SparkSession, path: str) -> None:
    fs, of = _files(spark, path)
    fs.delete(of(path), True)


def vacuum(spark: SparkSession, folder: str, folders, keep: int = 2) -> list[str]:
    """Deletes the data folders and pointers that the newest `keep` versions do not name, also what failed writers left; names of the folders that went. folders: gives
    those of a version's content, as names in `data`. Not to be called while a writer is at work."""
    fs, of = _files(spark, folder)
    numbers = _numbers(fs, of, folder)
    used = {name for n in numbers[:keep] for name in folders(current(spark, folder, n)[1])}
    data = of(f"{folder}/data")
    gone = [f.getPath() for f in fs.listStatus(data) if f.getPath().getName() not in used] if fs.exists(data) else []
    for path in gone:
        fs.delete(path, True)
    for n in numbers[keep:]:
        fs.delete(of(f"{folder}/_versions/{n:010}.json"), False)
    return sorted(p.getName() for p in gone)


def publish(tables: dict[str, DataFrame], folder: str, write=write_fact) -> dict[str, int]:
    """Writes all tables, refuses an empty one, and then puts a version with all of them: readers see the tables of one run, before and after. What
    was there stays if anything fails. Tables that are not given stay as they are. Returns the row counts."""
    spark, run = next(iter(tables.values())).sparkSession, new_run()
    base, content = current(spark, folder)
    counts = {}
    try:
        for name, df in tables.items():
            seen = Observation()
            write(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{folder}/data/{run}/{name}")
            counts[name] = seen.get["n"]
            if not counts[name]:
                raise ValueError(f"{name} has no rows; nothing was published")
        put(spark, folder, base, {"tables": content.get("tables", {}) | {name: run for name in tables}})
    except BaseException:
        drop(spark, f"{folder}/data/{run}")
        raise
    return counts


class Reader:
    """The tables of one version; all reads see the same one."""

    def __init__(self, spark: SparkSession, folder: str, version: int | None = None):
        self.spark, self.folder = spark, folder
        self.version, self.content = current(spark, folder, version)

    def path(self, name: str) -> str:
        return f"{self.folder}/data/{self.content['tables'][name]}/{name}"

    def table(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))


def vacuum_tables(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    return vacuum(spark, folder, lambda content: set(content.get("tables", {}).values()), keep)
