"""Tables between stages, and numbering over many partitions."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: A word is a run of anything but these; the same class in Java, Python and RE2 patterns.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir. Where that is unset, a temporary folder serves in local mode only, as in tests: on a cluster every
    machine would write to its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stored(spark: SparkSession) -> None:
    """Deletes all stored tables of this application; none of its DataFrames can be used after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Paths of the tables that stored() has written since noted() began.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that are stored meanwhile, in their order."""
    token = _noted.set([])
    try:
        yield _noted.get()
    finally:
        _noted.reset(token)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Deletes stored tables; DataFrames that read them cannot be used after that."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there, and a lost
    executor costs no recomputation of what went before."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _noted.get() is not None:
        _noted.get().append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash60(*cols: Column) -> Column:
    """60 bits of MD5 as a long, the same in SQL engines that have md5()."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, group: list[str], order: list[str], amount: Column, name: str) -> DataFrame:
    """df with `name`: the sum of amount over the earlier rows of its group by `order`, which must end in a column that no two rows share. Rows are dealt out by
    ranges of group and order, so that no task holds a group, nor the rows alike in all but that column: sums of ranges are summed first, then
    rows within one range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(df.repartitionByRange(parts, *group, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy(*group, "__part").agg(F.sum(amount).alias("__sum"))
    over = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    before = sums.select(*group, "__part", F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    same = F.col("l.__part") == F.col("r.__part")
    for c in group:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    inner = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumn("__local", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    joined = local.alias("l").join(before.alias("r"), same)
    return joined.select("l.*", "r.__before").withColumn(name, F.col("__before") + F.col("__local")).drop("__before", "__local", "__part")


def keep_rows(docs: DataFrame, rows: DataFrame, key: Column, name: str, kept: str) -> DataFrame:
    """The rows of docs whose doc_id and key are among those of rows where `kept` holds. rows: one for each row of docs, with doc_id
    and the key as `name`. Of rows alike in both, which would all come, one stays."""
    found = rows.filter(kept).select(F.col("doc_id").alias("__loom_doc"), F.col(name).alias("__loom_name")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__loom_doc")) & (F.col("__loom_key") == F.col("__loom_name"))
    out = docs.withColumn("__loom_key", key).join(stored(found, "kept-rows"), same, "left_semi")
    if not rows.groupBy("doc_id", name).count().filter("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "__loom_key"])
    return out.drop("__loom_key")
