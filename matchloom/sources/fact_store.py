"""A fact by release whose releases can change: appended batch by batch, and restated where a new release table says otherwise.

A version (see versions) names for each release the runs whose files hold its rows. A batch is a further run of the releases it has, and is taken once, by its number. After a
change to the release table only the releases at affected times are written anew: the intervals in which the old and the new table name different releases tell
which. Readers see one version, so never a half-restated fact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.asof import asof
from . import versions
from .landing import unsorted_folders


def changed_intervals(old: DataFrame, new: DataFrame) -> DataFrame:
    """start_ts, end_ts (exclusive, null for the last), old, new: the intervals at which two release tables (name, start_ts) name different releases, with null before the
    first. Of releases that start together the last by name counts."""
    side = lambda t, own, other: t.filter("start_ts is not null").groupBy("start_ts").agg(F.max("name").alias(own)).withColumn(other, F.lit(None).cast("string"))
    marks = side(old, "old", "new").unionByName(side(new, "new", "old")).groupBy("start_ts").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    ordered = Window.orderBy("start_ts")  # a dimension: a row for each start
    sooner = ordered.rowsBetween(Window.unboundedPreceding, 0)
    rows = marks.select("start_ts", F.lead("start_ts").over(ordered).alias("end_ts"), F.last("old", True).over(sooner).alias("old"), F.last("new", True).over(sooner).alias("new"))
    return rows.filter(~F.col("old").eqNullSafe(F.col("new")))


def _part(name: Column) -> Column:
    """A release's folder."""
    return F.md5(name)


class FactStore:
    """The newest version of a fact in a folder. schema: of its rows, with the release as `patch`."""

    def __init__(self, spark: SparkSession, folder: str, schema):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.refresh()

    def refresh(self) -> None:
        self.version, content = versions.current(self.spark, self.folder)
        #: For each release its folder's name and its runs.
        self.parts: dict[str, list] = content.get("parts", {})
        self.batch: int = content.get("batch", -1)

    def read(self, patches: list[str] | None = None) -> DataFrame:
        """The rows of all releases, or of some; nothing of the others is read."""
        wanted = [self.parts[p] for p in (self.parts if patches is None else patches) if p in self.parts]
        paths = [f"{self.folder}/data/{run}/part={part}" for part, runs in wanted for run in runs]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, run: str) -> dict[str, str]:
        """Writes rows as a run; the folder of each release that has rows."""
        top = f"{self.folder}/data/{run}"
        with unsorted_folders(self.spark):
            rows.withColumn("part", _part(F.col("patch"))).write.partitionBy("part").option("compression", "zstd").parquet(top)
        found = self.spark.read.schema("patch string, part string").parquet(top).groupBy("patch", "part").count().collect()  # a row for each release
        return {r["patch"]: r["part"] for r in found}

    def _put(self, run: str, parts: dict[str, list], batch: int) -> None:
        try:
            versions.put(self.spark, self.folder, self.version, {"parts": {p: x for p, x in parts.items() if x[1]}, "batch": batch})
        except versions.Conflict:
            versions.drop(self.spark, f"{self.folder}/data/{run}")
            raise
        self.refresh()

    def append(self, rows: DataFrame, batch: int | None = None) -> bool:
        """Adds rows. A batch (numbers ascend) that is in already is left out."""
        if batch is not None and batch <= self.batch:
            return False
        run = versions.new_run()
        written = self._write(rows, run)
        parts = dict(self.parts) | {p: [part, [*self.parts.get(p, [part, []])[1], run]] for p, part in written.items()}
        self._put(run, parts, self.batch if batch is None else batch)
        return True

    def restate(self, old: DataFrame, new: DataFrame, raw: Callable[[], DataFrame] | None = None, fact=None, time: str = "start_time") -> list[str]:
        """Makes the fact what it would be under the new release table, and gives the names of the releases that were written or went.

        Rows whose release has changed are found in the old one's files and labelled again by `time`. If the new table starts earlier than the old one, matches that
        had no release come from the landing zone: raw() and fact(raw, releases) give them.
        """
        changed = changed_intervals(old, new)
        rows = changed.collect()  # as many as releases
        touched = sorted({r[side] for r in rows for side in ("old", "new")} - {None})
        if not touched:
            return []
        run = versions.new_run()
        kept = asof(self.read(touched).drop("patch"), new, time, "patch").select(*self.schema.names)
        if any(r["old"] is None for r in rows):
            if raw is None or fact is None:
                raise ValueError("the new table starts earlier: the landed matches are needed")
            until = old.agg(F.min("start_ts")).first()[0]
            before = raw() if until is None else raw().filter(F.col("startDateTime") < until)
            kept = kept.unionByName(fact(before, new).select(*self.schema.names))
        written = self._write(kept, run)
        parts = {p: x for p, x in self.parts.items() if p not in touched} | {p: [part, [run]] for p, part in written.items()}
        self._put(run, parts, self.batch)
        return touched

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes the runs that the newest `keep` versions do not name."""
        return versions.vacuum(self.spark, self.folder, lambda content: {run for _, runs in content.get("parts", {}).values() for run in runs}, keep)
