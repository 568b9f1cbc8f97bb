"""Reports on the data: coverage, labels, unlogged items and schema drift."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..sources import landing
from ..sources.schemas import field_paths
from .asof import asof, nearest
from .facts import held_items

STALE_DAYS = 45
#: Version ids from here on are frozen and say nothing.
FROZEN_VERSION = 182
# Items that are held but never logged as bought.
UNLOGGED_ITEMS = (1847, 1848, 1849, 1851, 1852, 1853, 1854, 1855, 1856, 1857, 1858, 1872)
# The ages in days at which older data is looked for.
RETENTION_LADDER = (30, 60, 90, 120, 180, 240, 300, 330, 365, 400, 430)


def coverage(facts: DataFrame) -> DataFrame:
    """Matches and parsed matches per patch. The first aggregation is by match, so that no patch's ids meet in one task."""
    each = facts.groupBy("patch", "match_id").agg(F.max("is_parsed").alias("parsed"), F.min("start_time").alias("start"))
    sums = each.groupBy("patch").agg(F.count("match_id").alias("matches"), F.count_if("parsed").alias("parsed_matches"), F.min("start").alias("first_start"))
    return sums.withColumn("percent_parsed", S.percent(F.col("parsed_matches"), F.col("matches")))


def newest_patch(facts: DataFrame, patches: DataFrame) -> DataFrame:
    """The patch with the newest match, the days from its release to it, and whether these are too many."""
    newest = facts.groupBy("patch").agg(F.max("start_time").alias("newest")).join(patches.select(F.col("name").alias("patch"), "start_ts"), "patch")
    lag = S.days_between(F.col("newest"), F.col("start_ts"))
    return newest.orderBy(F.col("newest").desc(), "patch").limit(1).select("patch", "newest", lag.alias("lag_days"), (lag > STALE_DAYS).alias("stale"))


def patch_age(patches: DataFrame, now: int) -> DataFrame:
    """The newest release, its day, its age in days at `now`, and whether releases are probably missing since."""
    newest = patches.agg(F.max_by("name", F.struct("start_ts", "name")).alias("name"), F.max("start_ts").alias("start_ts"))
    age = S.days_between(F.lit(now), F.col("start_ts"))
    return newest.select("name", S.iso_date(F.col("start_ts")).alias("day"), age.alias("age_days"), (age > STALE_DAYS).alias("stale"))


def version_crosscheck(raw: DataFrame, patches: DataFrame, versions: DataFrame, limit: int = 10) -> DataFrame:
    """Where the landed version id names another release than the as-of join, before the ids froze."""
    rows = asof(raw.select("startDateTime", "gameVersionId").filter(F.col("gameVersionId") < FROZEN_VERSION), patches)
    counts = rows.groupBy("gameVersionId", "patch").agg(F.count("*").alias("n"))  # before the join: a few rows are left
    named = counts.join(versions.select(F.col("id").alias("gameVersionId"), F.col("name").alias("version")), "gameVersionId", "left")
    named = named.filter(~F.col("version").eqNullSafe(F.col("patch"))).groupBy("version", "patch").agg(F.sum("n").alias("n"))
    return named.orderBy(F.col("n").desc(), "version", "patch").limit(limit)


def before_first(raw: DataFrame, patches: DataFrame) -> DataFrame:
    """How many matches started before any release."""
    first = patches.agg(F.min("start_ts").alias("first"))
    return raw.select("startDateTime").join(F.broadcast(first), F.col("startDateTime") < F.col("first")).agg(F.count("*").alias("n"))


def unlogged_held(facts: DataFrame, items: tuple = UNLOGGED_ITEMS) -> DataFrame:
    return held_items(facts).filter(F.col("item_id").isin(*items)).agg(F.count("*").alias("slots"))


def unlogged_bought(events: DataFrame, items: tuple = UNLOGGED_ITEMS) -> DataFrame:
    return events.filter(F.col("item_id").isin(*items)).agg(F.count("*").alias("purchases"))


def unlogged_rate(facts: DataFrame, events: DataFrame, items: tuple = UNLOGGED_ITEMS) -> DataFrame:
    """Of the items held in parsed matches, the share that has a purchase, for the listed items and the others."""
    keys = ["match_id", "hero_id", "item_id"]
    bought = events.select(*keys).distinct().withColumn("logged", F.lit(1))
    rows = held_items(facts.filter("is_parsed")).select(*keys).join(bought, keys, "left")
    return rows.groupBy(F.col("item_id").isin(*items).alias("listed")).agg(F.count("*").alias("held"), F.avg(F.coalesce("logged", F.lit(0))).alias("logged_share"))


def unlogged_share(rows: DataFrame, items: tuple = UNLOGGED_ITEMS) -> DataFrame:
    """The same of rows of facts.held_and_bought."""
    return rows.groupBy(F.col("item_id").isin(*items).alias("listed")).agg(F.count("*").alias("held"), F.avg(F.col("logged").cast("int")).alias("logged_share"))


def paths_frame(spark, schema: T.DataType | str, name: str = "path") -> DataFrame:
    return spark.createDataFrame([(p,) for p in sorted(set(field_paths(schema)))], f"{name} string")


def drift(requested: DataFrame, pinned: DataFrame) -> DataFrame:
    """kind, path of fields on one side only."""
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "path")
    return tag(requested.subtract(pinned), "not pinned").unionByName(tag(pinned.subtract(requested), "never requested"))


#: In a variant's schema as Spark writes it: a key, quoted or not; what opens and closes a nested type.
_SCHEMA_TOKEN = re.compile(r"`((?:[^`]|``)*)`: |(\w+): |((?:OBJECT|ARRAY)<)|(>)")


def schema_paths(schema: str, prefix: str = "") -> set[str]:
    """Dotted paths of all keys in a variant's schema."""
    out, stack, own = set(), [prefix], prefix
    for quoted, bare, opens, closes in _SCHEMA_TOKEN.findall(schema):
        if opens:
            stack.append(own)
        elif closes:
            own = stack.pop()
        else:
            key = bare or quoted.replace("``", "`")
            own = f"{stack[-1]}.{key}" if stack[-1] else key
            out.add(own)
    return out


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(g, p) for g, prefix, schema in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in schema_paths(schema, prefix)]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["group", "path"])


def observed_paths(lines: DataFrame, group: Column | None = None) -> DataFrame:
    """group, path: the paths of all keys in JSON texts (column value), also of all elements of lists, by group. A key that has records in one place and other values
    in another has its inner paths, too.

    Each text's schema is made by Spark, and the different ones of a group are taken apart on the executors. A schema with a VARIANT in it hides what is in
    a list of unlike elements, so such a text, of which there are few, is walked into, level by level, until its parts have schemas of their own.
    """
    of = F.lit("") if group is None else F.coalesce(group, F.lit(""))
    values = lines.filter(F.trim("value") != "").select(of.alias("group"), F.lit("").alias("prefix"), F.parse_json("value").alias("v"))
    spark, found, unlike = lines.sparkSession, None, F.col("schema").rlike("VARIANT(?!:)")

    def written(rows: DataFrame, kind: str) -> DataFrame:
        path = landing.shared_path(spark, "schemas")
        rows.write.parquet(path)
        return spark.read.schema(kind).parquet(path)

    while True:
        schemas = values.withColumn("schema", F.schema_of_variant("v"))
        told = written(schemas.select("group", "prefix", "schema").distinct(), "group string, prefix string, schema string")  # also of texts that are walked into: it has their upper paths
        paths = told.mapInArrow(_taken_apart, "group string, path string")
        found = paths if found is None else found.union(paths)
        if told.filter(unlike).isEmpty():
            return found.distinct()
        values = written(schemas.filter(unlike).select("group", "prefix", "v"), "group string, prefix string, v variant")
        values = values.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select("key", F.col("value").alias("inner")))
        name = F.when(F.col("key").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.when(F.col("prefix") == "", "").otherwise("."), F.col("key")))
        values = values.select("group", name.alias("prefix"), F.col("inner").alias("v"))


def field_usage(rows: DataFrame, paths: list[str]) -> DataFrame:
    """path, n: how many records, or elements of an array of records, have a value in each of the fields, given as `field` or `array.field`."""

    def count(path: str) -> Column:
        outer, _, inner = path.partition(".")
        filled = F.size(F.filter(outer, lambda x: x[inner].isNotNull())) if inner else F.col(outer).isNotNull().cast("int")
        return F.coalesce(F.sum(F.greatest(filled, F.lit(0)).cast("long")), F.lit(0).cast("long"))

    pairs = F.array(*[F.struct(F.lit(p).alias("path"), count(p).alias("n")) for p in paths])
    return rows.agg(pairs.alias("pairs")).select(F.explode("pairs").alias("p")).select("p.path", "p.n")


def stale_shards(lines: DataFrame, requested: DataFrame, group: Column, preview: int = 4) -> DataFrame:
    """Shards whose records lack requested paths: file, missing (a number), first_missing. lines: value, the shard by `group`; for a look at
    the first records of each shard only, give a scan that stops there."""
    seen = observed_paths(lines, group)
    wanted = seen.select("group").distinct().crossJoin(F.broadcast(requested))  # shards by pinned fields
    gaps = wanted.join(seen, ["group", "path"], "left_anti").groupBy("group").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return gaps.select(F.col("group").alias("file"), F.size("paths").alias("missing"), F.array_join(F.slice("paths", 1, preview), ",").alias("first_missing"))


def version_sample(raw: DataFrame, versions: DataFrame, dates: DataFrame, now: int) -> DataFrame:
    """For each date (start_ts) up to now the nearest match, its version id and that version's name."""
    targets = dates.filter(F.col("target_ts") <= now)
    hits = nearest(targets, raw, "target_ts", "startDateTime", "id").join(raw.select("id", "gameVersionId").dropDuplicates(["id"]), "id")
    named = hits.join(versions.select(F.col("id").alias("gameVersionId"), "name"), "gameVersionId", "left")
    return named.select("target_ts", F.col("id").alias("match_id"), F.col("gameVersionId").alias("version_id"), F.coalesce("name", F.lit("?")).alias("version"))


def retention(rows: DataFrame, time: str, now: int, ages: tuple = RETENTION_LADDER) -> DataFrame:
    """For each age in days whether there are rows at least as old, and the greatest such age."""
    spark = rows.sparkSession
    oldest = rows.agg(F.min(time).alias("oldest"))
    ladder = spark.createDataFrame([(a,) for a in ages], "age_days int")
    marked = ladder.crossJoin(oldest).select("age_days", F.coalesce(F.col("oldest") <= F.lit(now) - F.col("age_days") * S.SECONDS_PER_DAY, F.lit(False)).alias("has_data"))
    deepest = marked.filter("has_data").agg(F.max("age_days").alias("deepest"))
    return marked.crossJoin(deepest)
