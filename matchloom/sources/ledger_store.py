"""A stored ledger: rows by match_id in buckets, changed bucket by bucket.

A version (see versions) names for each bucket the runs whose files hold its rows. An update reads the buckets that it touches, writes these anew and puts a version in
which only they have changed; added rows are a further run of their buckets. Updates are brought to the ledger's files by a broadcast after a check
of their number, so the ledger itself is never shuffled; beyond that the join is Spark's to choose, of the touched buckets.

Beside the rows of each run and bucket stands a Bloom filter of their ids: words of 64 bits, of which an id sets four in one word. Ids that no filter knows are new
and are added without a look at the ledger; the others are looked up exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger
from . import schemas, versions

#: Updates of up to so many rows are broadcast.
MOST_BROADCAST = 100_000
#: Ids for each word of a filter: about 11 bits an id.
_IDS_PER_WORD = 6
#: Runs of a bucket after which it is written as one.
_MOST_RUNS = 8
_FILTER = "word bigint, bits bigint"


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("match_id"), F.lit(buckets)).cast("int")


def _bits() -> Column:
    """The four bits that an id sets in its word."""
    h, out = F.xxhash64(F.lit(2), F.col("match_id")), F.lit(0).cast("bigint")
    for i in range(4):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return out


def _word(words: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), F.col("match_id")), words)


def _small(rows: DataFrame) -> DataFrame:
    """rows, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else rows


class LedgerStore:
    """The newest version of the ledger in a folder. Every change puts a version, and fails with versions.Conflict if another one was put meanwhile."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.refresh()

    def refresh(self) -> None:
        self.version, content = versions.current(self.spark, self.folder)
        self.buckets = content.get("buckets", 0)
        #: For each bucket its runs, each with the number of words of its filter.
        self.runs: dict[str, list] = content.get("runs", {})

    @staticmethod
    def create(rows: DataFrame, folder: str, buckets: int = 64) -> LedgerStore:
        """A new ledger of rows with one row for each match_id. Buckets should hold some hundred thousand rows."""
        store = LedgerStore(rows.sparkSession, folder)
        if store.version:
            raise ValueError(f"there is a ledger in {folder}")
        store.buckets = buckets
        written = store._write(rows.select(*_columns()).withColumn("bucket", bucket_of(buckets)).repartition("bucket"))
        store._put(written, {b: [] for b in range(buckets)})
        return store

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some; nothing of the others is read."""
        wanted = self.runs if buckets is None else {str(b): self.runs.get(str(b), []) for b in buckets}
        paths = [f"{self.folder}/data/{run}/rows/bucket={b}" for b, runs in wanted.items() for run, _ in runs]
        return self.spark.read.schema(schemas.LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], schemas.LEDGER)

    def _touched(self, rows: DataFrame) -> list[int]:
        """The buckets of rows; as many numbers as there are buckets at most."""
        return sorted(r["bucket"] for r in rows.select(bucket_of(self.buckets).alias("bucket")).distinct().collect())

    def _write(self, rows: DataFrame) -> dict[int, list]:
        """Writes rows (with their bucket) and their filters as a new run; the run for each bucket that has rows."""
        run = versions.new_run()
        top = f"{self.folder}/data/{run}"
        rows.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{top}/rows")
        written = self.spark.read.schema(f"{schemas.LEDGER}, bucket int").parquet(f"{top}/rows").select("match_id", "bucket")
        words = {r["bucket"]: max(1, -(-r["n"] // _IDS_PER_WORD)) for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        if words:
            of = self.spark.createDataFrame(sorted(words.items()), "bucket int, words bigint")  # a row for each bucket
            sized = written.join(F.broadcast(of), "bucket")
            filters = sized.select("bucket", _word(F.col("words")).alias("word"), _bits().alias("bits")).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
            filters.repartition("bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{top}/filters")
        return {b: [run, n] for b, n in words.items()}

    def _put(self, written: dict[int, list], kept: dict[int, list]) -> None:
        """A version with what was written beside the kept runs of the touched buckets; other buckets stay."""
        runs = dict(self.runs) | {str(b): [*old, *([written[b]] if b in written else [])] for b, old in kept.items()}
        try:
            versions.put(self.spark, self.folder, self.version, {"buckets": self.buckets, "runs": {b: r for b, r in runs.items() if r}})
        except versions.Conflict:
            for run in {r for r, _ in written.values()}:
                versions.drop(self.spark, f"{self.folder}/data/{run}")
            raise
        self.refresh()

    def _rewrite(self, touched: list[int], change) -> list[int]:
        """Writes the touched buckets anew as change(rows); the buckets."""
        if touched:
            rows = change(self.read(touched)).select(*_columns())
            self._put(self._write(rows.withColumn("bucket", bucket_of(self.buckets))), {b: [] for b in touched})
        return touched

    def apply_outcomes(self, outcomes: DataFrame, raw_file: str) -> list[int]:
        """ledger.apply_outcomes, stored; outcomes: one for each match_id. The buckets that were written."""
        told = outcomes.select("match_id", "outcome", "error")
        return self._rewrite(self._touched(told), lambda rows: ledger.apply_outcomes(rows, _small(told), raw_file))

    def remove_walks(self, walks: list[str], include_fetched: bool = False) -> list[int]:
        """ledger.without_walks, stored. Only buckets with rows that go are written."""
        gone = ledger.of_walks(self.read(), walks, include_fetched)
        return self._rewrite(self._touched(gone), lambda rows: ledger.without_walks(rows, walks, include_fetched))

    def _maybe_known(self, ids: DataFrame) -> DataFrame:
        """The ids that a filter knows. ids: match_id."""
        touched = self._touched(ids)
        filters = [(run, b, words) for b in touched for run, words in self.runs.get(str(b), [])]
        if not filters:
            return ids.limit(0)
        of = self.spark.createDataFrame(filters, "run string, bucket int, words bigint")  # buckets by runs of each
        asked = ids.withColumn("bucket", bucket_of(self.buckets)).join(F.broadcast(of), "bucket").select("match_id", "run", "bucket", _word(F.col("words")).alias("word"), _bits().alias("wanted"))
        paths = [f"{self.folder}/data/{run}/filters/bucket={b}" for run, b, _ in filters]
        at = F.col("_metadata.file_path")
        stored = self.spark.read.schema(_FILTER).parquet(*paths).select("*", F.regexp_extract(at, "/data/([0-9a-f]+)/filters/", 1).alias("run"), F.regexp_extract(at, r"/bucket=(\d+)/", 1).cast("int").alias("bucket"))
        hits = stored.join(_small(asked), ["run", "bucket", "word"]).filter(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
        return hits.select("match_id").distinct()

    def insert_or_ignore(self, rows: DataFrame, order: list[Column]) -> DataFrame:
        """Adds the rows with ids that the ledger does not have, of several with one id the first by `order`; the added rows. Columns that
        rows lack are null; rows without an id are none."""
        first = ledger.insert_or_ignore(rows.select("match_id").limit(0), rows.filter("match_id is not null"), order)
        top = f"{self.folder}/data/{versions.new_run()}"
        first.write.parquet(f"{top}/first")  # once: the rows are asked for several times
        first = self.spark.read.schema(first.schema).parquet(f"{top}/first")
        maybe = self._maybe_known(first.select("match_id"))
        buckets = self._touched(maybe)
        if buckets:
            known = self.read(buckets).select("match_id").join(_small(maybe), "match_id", "left_semi")
            added = first.join(known, "match_id", "left_anti")
        else:
            added = first
        full = added.select(*[F.col(c) if c in added.columns else F.lit(None).cast(t).alias(c) for c, t in _columns().items()])
        touched = self._touched(added)
        if touched:
            written = self._write(full.withColumn("bucket", bucket_of(self.buckets)).repartition("bucket"))
            run = next(iter(written.values()))[0]
            self._put(written, {b: self.runs.get(str(b), []) for b in touched})
            paths = [f"{self.folder}/data/{run}/rows/bucket={b}" for b in written]
            added = self.spark.read.schema(schemas.LEDGER).parquet(*paths).select(*rows.columns)
        else:
            added = rows.limit(0)
        versions.drop(self.spark, top)
        return added

    def compact(self, most_runs: int = _MOST_RUNS) -> list[int]:
        """Writes buckets of more than so many runs as one."""
        return self._rewrite([int(b) for b, runs in self.runs.items() if len(runs) > most_runs], lambda rows: rows)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes the runs that the newest `keep` versions do not name."""
        return versions.vacuum(self.spark, self.folder, lambda content: {run for runs in content.get("runs", {}).values() for run, _ in runs}, keep)


def _columns() -> dict[str, str]:
    """Columns of the ledger and their types."""
    return dict(c.strip().split(" ") for c in schemas.LEDGER.split(","))
