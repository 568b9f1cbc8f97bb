"""Landing zone, dimension tables, partitioned facts, and publishing them."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schemas, shards

#: How shards are written: at level 3 a shard takes less time than its records do.
GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}
#: Folders that a task of a partitioned write has open at once; rows of further ones are sorted.
OPEN_FOLDERS = 32
#: Shuffled bytes for a task that lands matches. What is shuffled is narrow: of so much a task makes some 120 MB of JSON, a shard of some 20 MB.
LANDED_BYTES = 4 << 20
#: Bytes of shards for a task of a stream: half of Spark's own limit, as they become six times as many.
READ_BYTES = 64 << 20


@contextmanager
def _set(spark: SparkSession, **settings) -> Iterator[None]:
    """The session with other settings spark.sql.*, and with its own again after that."""
    settings = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in here put each row into its folder as it comes: no task sorts (and spills) its rows by folder first, unless it has more folders than can be open."""
    with _set(spark, maxConcurrentOutputFileWriters=OPEN_FOLDERS):
        yield


@contextmanager
def in_order(spark: SparkSession) -> Iterator[None]:
    """Lists that are collected in here come from rows in the order of their key, one key after the other: rows that are narrow when they are sorted are not sorted again when they are
    records. Tasks are small enough that the last ones do not wait for one, and so are the shards that they write, which cannot be divided by readers."""
    with _set(spark, execution__useObjectHashAggregateExec="false", adaptive__advisoryPartitionSizeInBytes=LANDED_BYTES):
        yield


@contextmanager
def small_reads(spark: SparkSession) -> Iterator[None]:
    """Tasks that read in here take fewer shards each, so that a second round of few tasks does not take as long as the first."""
    with _set(spark, files__maxPartitionBytes=READ_BYTES):
        yield


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir. Where that is unset, a temporary folder serves in local mode only: on a cluster every machine
    would write to its own."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{top.rstrip('/')}/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_shared(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; none of its DataFrames can be used after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scan_raw(spark: SparkSession, paths, partitions: int | None = None, player: tuple | None = None) -> DataFrame:
    """Landed matches under the pinned schema; a value of another type fails the read. Gzip shards are not split, so
    give partitions to deal the rows out after the scan. player: the fields of players that are wanted; as with columns, Spark takes no others apart."""
    rows = spark.read.schema(schemas.RAW if player is None else schemas.with_player(player)).option("mode", "FAILFAST").json(paths)
    return rows.repartition(partitions) if partitions else rows


def scan_shards(spark: SparkSession, folder: str, most: int | None = None, give: str = "records") -> DataFrame:
    """The rows of shards.ShardSource: records of the *.gz shards in the folder and those inside it, and a row for each shard. Each shard is read once. In a store that
    only Spark can open a shard comes as one value, of 2 GB at most, and shards without a byte are passed over."""
    try:
        shards.store_of(folder)
    except pa.ArrowInvalid:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).load(folder)
        if give == "names":
            return files.select(F.col("path").alias("file"), *[F.lit(None).cast(t).alias(c) for c, t in (("record", "string"), ("reason", "string"), ("records", "long"))], F.col("length").alias("bytes"))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                    yield from shards.shard_batches(name, io.BytesIO(content.as_buffer()), most, give == "records")

        return files.select("path", "content").mapInArrow(read, "file string, record string, reason string, records long, bytes long")
    spark.dataSource.register(shards.ShardSource)
    reader = spark.read.format(shards.ShardSource.name()).option("give", give)
    return (reader.option("most", most) if most else reader).load(folder)


def shard_health(spark: SparkSession, folder: str) -> DataFrame:
    """file, ok, reason of each *.gz shard in the folder and those inside it. A shard that does not decompress to its end is bad as a whole: Spark would keep the
    rows before the damage."""
    return scan_shards(spark, folder, give="health").select("file", F.col("reason").isNull().alias("ok"), "reason")


def scan_healthy(spark: SparkSession, folder: str, partitions: int | None = None, player: tuple | None = None) -> DataFrame:
    """Landed matches of the shards that can be read to their end: a damaged one costs its own rows and not the scan. A value of another type fails
    the read. player: the fields of players that are wanted, as in scan_raw."""
    lines = scan_shards(spark, folder).filter("record is not null").select("record")
    lines = lines.repartition(partitions) if partitions else lines
    schema = schemas.RAW if player is None else schemas.with_player(player)
    return lines.select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def landing_summary(spark: SparkSession, folder: str, shard: Column | None = None) -> DataFrame:
    """shards, bytes: their number and the sum of their sizes, of which nothing is read. shard: the name of a file's shard, where shards come in pieces."""
    names = scan_shards(spark, folder, give="names")
    return names.agg((F.count("*") if shard is None else F.countDistinct(shard)).alias("shards"), F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("bytes"))


def _files(spark: SparkSession, folder: str):
    """The file system of a folder and its path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _renamed(fs, old, new) -> None:
    """A rename that fails aloud: file systems tell by the result, and move into a folder that is there."""
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def write_landing(rows: DataFrame, folder: str) -> bool:
    """Appends gzip JSON shards of new names; nothing is written if there are no rows. Rows are computed once: shards are written aside and
    moved in one by one when they are whole."""
    spark, seen = rows.sparkSession, Observation()
    aside = f"{folder.rstrip('/')}-aside-{uuid.uuid4().hex}"
    fs, path = _files(spark, aside)
    try:
        with in_order(spark):
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**GZIP).json(aside)
        if not seen.get["n"]:
            return False
        fs.mkdirs(path(folder))
        for f in fs.listStatus(path(aside)):
            if f.getPath().getName().startswith("part-"):
                _renamed(fs, f.getPath(), path(f"{folder}/{f.getPath().getName()}"))
        return True
    finally:
        fs.delete(path(aside), True)


def scan_overrides(spark: SparkSession, path: str) -> DataFrame:
    """A hand-kept JSON array of {name, date}."""
    return spark.read.schema(schemas.OVERRIDES).option("multiLine", True).json(path)


def scan_item_constants(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row per item of JSON objects keyed by short name."""
    parsed = F.from_json(F.col(column), schemas.ITEM_CONSTANTS, {"mode": "FAILFAST"})
    return texts.select(F.explode(parsed).alias("short_name", "item")).select("short_name", "item.*")


def write_dimension(df: DataFrame, path: str) -> bool:
    """A table that replaces another as a whole, a file of each task that has rows; what stands there stays if there are no rows. Rows are computed once."""
    spark, seen = df.sparkSession, Observation()
    aside = f"{path.rstrip('/')}-aside-{uuid.uuid4().hex}"
    fs, of = _files(spark, aside)
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(aside)
        if seen.get["n"]:
            _replace(fs, of, {path: aside})
        return bool(seen.get["n"])
    finally:
        fs.delete(of(aside), True)


def read_dimension(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_fact(df: DataFrame, path: str) -> None:
    """Parquet by patch. Rows of a patch are dealt over tasks by Spark, so a patch with most rows is no single task; a task writes them as they come, without a sort."""
    with unsorted_folders(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static").partitionBy("patch").parquet(path)


def read_fact(spark: SparkSession, path: str, schema) -> DataFrame:
    """The patch is a string by its schema: inferred, 1.20 would become 1.2."""
    return spark.read.schema(schema).parquet(path)


def _replace(fs, path, tables: dict[str, str]) -> None:
    """Puts new tables in the place of old ones (new by old name), all or none: the old ones are kept beside and come back if any rename fails."""
    mark = uuid.uuid4().hex
    moved: list[tuple[str, str | None]] = []
    try:
        for target, new in tables.items():
            fs.mkdirs(path(target).getParent())
            old = f"{target}-old-{mark}" if fs.exists(path(target)) else None
            if old:
                _renamed(fs, path(target), path(old))
            moved.append((target, old))
            _renamed(fs, path(new), path(target))
    except BaseException:
        for target, old in reversed(moved):
            fs.delete(path(target), True)
            if old:
                _renamed(fs, path(old), path(target))
        raise
    for _, old in moved:
        if old:
            fs.delete(path(old), True)


def publish(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Writes all facts aside, refuses an empty one, and then replaces each table by a rename. What stood there before survives a
    failure, also of a rename; old partitions do not survive a success. A reader between two renames sees tables of both runs; on object stores a
    rename copies. Returns the row counts."""
    spark = next(iter(tables.values())).sparkSession
    staging = f"{folder}/_staging-{uuid.uuid4().hex}"
    fs, path = _files(spark, folder)
    counts = {}
    try:
        for name, df in tables.items():
            seen = Observation()
            write_fact(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{staging}/{name}")
            counts[name] = seen.get["n"]
            if not counts[name]:
                raise ValueError(f"{name} has no rows; nothing was replaced")
        _replace(fs, path, {f"{folder}/{name}": f"{staging}/{name}" for name in tables})
    finally:
        fs.delete(path(staging), True)
    return counts
