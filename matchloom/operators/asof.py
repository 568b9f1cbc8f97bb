"""As-of joins.

A small release table is broadcast, by the days that it covers; their number is checked first. Any other one is merged with the rows: both sides are dealt to parts of
the time line that hold about as many rows each, a window over a part finds the last release before a row, and what lies in earlier parts is carried over in a table of
one row for each part. An instant that many rows share covers several parts, over which they are dealt by their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import SECONDS_PER_DAY
from ..sources import landing

#: Releases and days of up to so many are broadcast; beyond, both sides are merged.
MOST_BROADCAST = 20_000
#: Parts of a time line at most: what the driver sees of it, and the rows of a carried table.
MOST_PARTS = 1 << 16


def intervals(patches: DataFrame) -> DataFrame:
    """name, start_ts, end_ts (exclusive; null for the last). Of releases that start together the last by name counts."""
    ordered = Window.orderBy("start_ts", "name")  # a dimension: one row per release
    rows = patches.select("name", "start_ts", F.lead("start_ts").over(ordered).alias("end_ts"))
    return rows.filter(F.col("end_ts").isNull() | (F.col("end_ts") > F.col("start_ts")))


def asof(rows: DataFrame, patches: DataFrame, time: str = "startDateTime", name: str = "patch") -> DataFrame:
    """rows with the name of the release in force: the one with the greatest start at or before `time`, of several with that start the last by name. Earlier
    rows, rows without a time and releases without a start drop out.

    The intervals of a few releases are spread over the days they cover and joined on the day, with the exact bounds as a residual; days after the last start count as
    that day. Many releases, or few that span many days, are merged with the rows (see asof_merged).
    """
    patches = patches.filter("start_ts is not null")
    bounds = patches.agg(F.min("start_ts").alias("first"), F.max("start_ts").alias("last"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return rows.withColumn(name, F.lit(None).cast("string")).limit(0)
    first, last = bounds["first"] // SECONDS_PER_DAY, bounds["last"] // SECONDS_PER_DAY
    if last - first + bounds["n"] > MOST_BROADCAST:  # the rows of `spread` at most
        return asof_merged(rows, patches, time, name)
    spans = intervals(patches)
    day: Column = F.floor(F.col("start_ts") / SECONDS_PER_DAY)
    until = F.coalesce(F.floor((F.col("end_ts") - 1) / SECONDS_PER_DAY), F.lit(last))
    spread = spans.select(F.col("name").alias("__name"), F.col("start_ts").alias("__start"), F.col("end_ts").alias("__end"), F.explode(F.sequence(day, until)).alias("__day"))
    at = F.col(time)
    inside = (at >= F.col("__start")) & (F.col("__end").isNull() | (at < F.col("__end")))
    keyed = rows.withColumn("__at", F.least(F.floor(at / SECONDS_PER_DAY), F.lit(last)))
    joined = keyed.join(F.broadcast(spread), (F.col("__at") == F.col("__day")) & inside)
    return joined.withColumn(name, F.col("__name")).drop("__name", "__start", "__end", "__day", "__at")


class Line:
    """A time line cut into parts of about as many of the given times each; times: single-column DataFrames."""

    def __init__(self, *times: DataFrame):
        spark = times[0].sparkSession
        n = max(2, min(MOST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        both = times[0].toDF("t")
        for t in times[1:]:
            both = both.union(t.toDF("t"))
        cuts = both.agg(F.percentile_approx("t", [i / n for i in range(1, n)], 50 * n)).first()[0]
        self.cuts = sorted(cuts or [0])

    def _upto(self, at: Column, strictly: bool) -> Column:
        """How many cuts are before `at`, or at it too: a binary search."""
        cuts, steps = F.split(F.lit(",".join(map(str, self.cuts))), ",").cast("array<bigint>"), [1 << k for k in reversed(range(len(self.cuts).bit_length()))]
        fits = lambda p, s: F.get(cuts, p + s - 1) < at if strictly else F.get(cuts, p + s - 1) <= at
        return F.aggregate(F.lit(steps), F.lit(0), lambda p, s: F.when(fits(p, s), p + s).otherwise(p))

    def first_part(self, at: Column) -> Column:
        """The first part that has rows of this time."""
        below, upto = self._upto(at, True), self._upto(at, False)
        return F.least(below + 1, upto)

    def part(self, at: Column, salt: Column) -> Column:
        """One of the parts that have rows of this time, by the salt."""
        below, upto = self._upto(at, True), self._upto(at, False)
        return F.least(below + 1, upto) + F.pmod(salt, F.greatest(upto - below, F.lit(1))).cast("int")


def _salt(rows: DataFrame) -> Column:
    """A hash of a row, the same whenever it is read."""
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))]
    return F.xxhash64(*plain)


def _carried(per_part: DataFrame, value: str, later: bool = False) -> DataFrame:
    """part, and the greatest `value` of all earlier parts (or the least of all later ones), for the parts that have any. per_part: part, value; a row for each part."""
    whole = per_part.sparkSession.range(MOST_PARTS + 1).select(F.col("id").cast("int").alias("part"))  # parts without releases carry, too
    rows = whole.join(per_part, "part", "left")
    over = Window.orderBy(F.col("part").desc() if later else F.col("part")).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("part", (F.min(value) if later else F.max(value)).over(over).alias("carried")).filter("carried is not null")


def asof_merged(rows: DataFrame, patches: DataFrame, time: str = "startDateTime", name: str = "patch") -> DataFrame:
    """asof for any number of releases at any distance: one shuffle of the rows, by part of the time line, and no broadcast but of one row for each part."""
    starts = patches.filter("start_ts is not null").groupBy("start_ts").agg(F.max("name").alias("name"))
    timed = rows.filter(F.col(time).isNotNull())
    line = Line(timed.select(F.col(time).cast("long")), starts.select("start_ts"))
    found = F.struct("start_ts", "name").alias("release")
    placed = starts.select(line.first_part(F.col("start_ts")).alias("part"), F.col("start_ts").alias("at"), found, F.lit(None).cast(rows.schema).alias("row"))
    left = timed.select(F.struct(*rows.columns).alias("row"), F.col(time).cast("long").alias("at"), _salt(rows).alias("salt"))
    left = left.select(line.part(F.col("at"), F.col("salt")).alias("part"), "at", F.lit(None).cast(placed.schema["release"].dataType).alias("release"), "row")
    over = Window.partitionBy("part").orderBy("at", F.col("row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = placed.unionByName(left).withColumn("own", F.last("release", True).over(over)).filter("row is not null")
    carried = _carried(placed.groupBy("part").agg(F.max("release").alias("release")), "release")
    joined = both.join(F.broadcast(carried), "part", "left").withColumn("release", F.coalesce("own", "carried")).filter("release is not null")
    return joined.select("row.*", F.col("release.name").alias("__name")).withColumn(name, F.col("__name")).drop("__name")


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once and read back."""
    path = landing.shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def nearest(targets: DataFrame, rows: DataFrame, target: str, time: str, key: str) -> DataFrame:
    """Each target time with the row closest in time, the one with the lower key if two are as close: targets' columns, key, distance. Targets
    without a time drop out, as do all where there are no rows.

    Of a few targets, a row lies between two neighbouring ones, found by the day as in asof, and one partial aggregation keeps the first and the last row between each
    two. Many targets, or few that span many days, are merged with the rows.
    """
    small = targets.select(F.col(target).cast("long").alias("t")).filter("t is not null").distinct()
    bounds = small.agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return targets.select(*targets.columns, F.lit(None).cast(rows.schema[key].dataType).alias(key), F.lit(None).cast("long").alias("distance")).limit(0)
    timed = rows.filter(F.col(time).isNotNull()).select(F.col(time).cast("long").alias("time"), F.col(key).alias("key"))
    timed = timed.groupBy("time").agg(F.min("key").alias("key"))  # of the rows at one time only that with the lowest key can be nearest
    few = bounds["last"] // SECONDS_PER_DAY - bounds["first"] // SECONDS_PER_DAY + bounds["n"] <= MOST_BROADCAST
    if not few:  # read four times
        targets, timed = _kept(targets, "targets"), _kept(timed, "times")
        small = _kept(targets.select(F.col(target).cast("long").alias("t")).filter("t is not null").distinct(), "distinct-targets")
    filled = _between_days(small, timed, bounds) if few else _beside(small, timed)
    hit = lambda distance, k: F.when(distance.isNotNull(), F.struct(distance.alias("distance"), k.alias("key")))
    best = F.least(hit(F.col("after.time") - F.col("t"), F.col("after.key")), hit(F.col("t") - F.col("before.time"), -F.col("before.key")))
    found = filled.select("t", best.alias("best")).filter("best is not null").select(F.col("t").alias("__t"), F.col("best.key").alias("__key"), F.col("best.distance").alias("__distance"))
    joined = targets.join(F.broadcast(found) if few else found, F.col(target) == F.col("__t"))
    return joined.select(*targets.columns, F.col("__key").alias(key), F.col("__distance").alias("distance"))


def _between_days(small: DataFrame, timed: DataFrame, bounds) -> DataFrame:
    """t, after (time, key of the first row from t on), before (time, -key of the last row before t), for a few times t."""
    first, last = bounds["first"] // SECONDS_PER_DAY, bounds["last"] // SECONDS_PER_DAY
    ordered = Window.orderBy("t")  # a row for each target
    spans = small.select(F.lag("t").over(ordered).alias("start"), F.col("t").alias("end")).union(small.agg(F.max("t"), F.lit(None).cast("long")))
    day = lambda c: F.floor(c / SECONDS_PER_DAY)
    spread = spans.select(
        F.col("start").alias("__start"), F.col("end").alias("__end"),
        F.explode(F.sequence(F.coalesce(day(F.col("start")), F.lit(first - 1)), F.coalesce(day(F.col("end") - 1), F.lit(last)))).alias("__day"),
    )
    timed = timed.withColumn("at", F.greatest(F.least(day(F.col("time")), F.lit(last)), F.lit(first - 1)))
    inside = (F.col("__start").isNull() | (F.col("time") >= F.col("__start"))) & (F.col("__end").isNull() | (F.col("time") < F.col("__end")))
    between = timed.join(F.broadcast(spread), (F.col("at") == F.col("__day")) & inside)
    ends = between.groupBy("__start", "__end").agg(F.min(F.struct("time", "key")).alias("after"), F.max(F.struct("time", (-F.col("key")).alias("key"))).alias("before"))
    after = small.join(ends.select(F.col("__start").alias("t"), "after"), "t", "left")
    both = after.join(ends.select(F.col("__end").alias("t"), "before"), "t", "left")
    later, sooner = ordered.rowsBetween(0, Window.unboundedFollowing), ordered.rowsBetween(Window.unboundedPreceding, 0)
    return both.select("t", F.first("after", True).over(later).alias("after"), F.last("before", True).over(sooner).alias("before"))


def _beside(small: DataFrame, timed: DataFrame) -> DataFrame:
    """The same for any number of times: both sides in parts of the time line, with what lies in earlier and in later parts carried over. Rows at t may come as before."""
    line = Line(timed.select("time"), small)
    hits = timed.select(line.part(F.col("time"), F.xxhash64("key")).alias("part"), "time", F.struct("time", "key").alias("after"), F.struct("time", (-F.col("key")).alias("key")).alias("before"))
    asked = small.select(line.first_part(F.col("t")).alias("part"), F.col("t").alias("time"), *[F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in ("after", "before")])
    both = hits.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
    # of rows at one time the lowest key is met last from either side
    sooner = Window.partitionBy("part").orderBy("time", "asked").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("part").orderBy(F.col("time").desc(), "asked").rowsBetween(Window.unboundedPreceding, 0)
    both = both.select("part", F.col("time").alias("t"), "asked", F.max("before").over(sooner).alias("before"), F.min("after").over(later).alias("after")).filter("asked")
    per_part = hits.groupBy("part").agg(F.max("before").alias("before"), F.min("after").alias("after"))
    for side, is_later in (("before", False), ("after", True)):
        carried = _carried(per_part.select("part", side), side, is_later).withColumnRenamed("carried", f"carried_{side}")
        both = both.join(F.broadcast(carried), "part", "left")
    return both.select("t", F.least("after", "carried_after").alias("after"), F.greatest("before", "carried_before").alias("before"))
