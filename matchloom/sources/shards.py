"""Gzip shards of a landing zone as a Spark data source.

Each shard is read from its store once, in a stream, by one task. Its records are given only when its end was reached, and else the reason why it was not: what
has been read is kept aside meanwhile, compressed as it came, in memory or, beyond 64 MB, in the task's own scratch file. With a limit on the records, reading stops
there. Shards are found by the source when the scan is planned, as by any file source; small ones share a task.
"""

from __future__ import annotations

import gzip
import io
import re
import tempfile
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of shards that share a task, bytes of a shard that are kept in memory, bytes and number of the records of a batch.
TASK_BYTES, KEPT_BYTES, BATCH_BYTES, BATCH_RECORDS = 64_000_000, 64_000_000, 4_000_000, 10_000
_KINDS = {"file": pa.string(), "record": pa.string(), "reason": pa.string(), "records": pa.int64(), "bytes": pa.int64()}


def store_of(folder: str) -> tuple[pafs.FileSystem, str, str]:
    """The store of a folder, its path there, and what comes before the path in names."""
    if not re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return pafs.LocalFileSystem(), folder, ""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/"), "file:"
    store, path = pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))
    return store, path, folder[: len(folder) - len(path)] if folder.endswith(path) else f"{folder.partition('://')[0]}://"


class Counted(io.RawIOBase):
    """A stream that counts what is read from it and copies it, if there is a copy to keep."""

    def __init__(self, stream, copy=None):
        self.stream, self.copy, self.n, self.head = stream, copy, 0, b""

    def peek(self, size: int) -> bytes:
        self.head = self.read(size)
        self.n -= len(self.head)
        return self.head

    def read(self, size: int = -1) -> bytes:
        if self.head:
            out, self.head = self.head, b""
            self.n += len(out)
            return out
        out = self.stream.read(None if size is None or size < 0 else size)
        self.n += len(out)
        if self.copy is not None:
            self.copy.write(out)
        return out


def _lines(stream) -> Iterator[bytes]:
    with gzip.GzipFile(fileobj=stream, mode="rb") as f:
        for line in f:
            line = line.strip(b"\r\n")
            if line.strip():
                yield line


def read_shard(stream, most: int | None = None, give: bool = True) -> Iterator[list[bytes] | tuple[str | None, int, int]]:
    """Lists of the records of a shard, the first `most` only if given and none unless `give`; then the reason why it cannot be read (or None), and the numbers of its
    records and of the bytes that were read. Failures of the store are raised, as they say nothing on the shard."""
    kept = tempfile.SpooledTemporaryFile(KEPT_BYTES) if give and most is None else None
    source = Counted(stream, kept)
    head, reason, found, records = source.peek(2), None, [], 0
    if head != b"\x1f\x8b":
        yield "not gzip" if head else "empty", 0, source.n + len(head)
        return
    try:
        if most is not None:
            found = list(islice(_lines(source), most))
            records = len(found)
        elif give:
            with gzip.GzipFile(fileobj=source, mode="rb") as f:
                while f.read(1 << 20):
                    pass
        else:
            for _ in _lines(source):
                records += 1
    except (gzip.BadGzipFile, EOFError, zlib.error) as e:
        reason = f"{type(e).__name__}: {e}"
    if reason is None and give:
        if kept is not None:
            kept.seek(0)
        held, size, records = [], 0, 0
        for line in _lines(kept) if kept is not None else found:
            held.append(line)
            records += 1
            size += len(line)
            if size >= BATCH_BYTES or len(held) >= BATCH_RECORDS:
                yield held
                held, size = [], 0
        if held:
            yield held
    if kept is not None:
        kept.close()
    yield reason, 0 if reason else records, source.n


def status_batch(name: str, records: list[bytes | None], reason: str | None, n: int | None, size: int | None) -> pa.RecordBatch:
    """Rows of one shard: its records, or its own row where the record is None."""
    columns = [[name] * len(records), [None if r is None else r.decode("utf-8", "replace") for r in records], *([x] * len(records) for x in (reason, n, size))]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _KINDS.values(), strict=True)], names=list(_KINDS))


def shard_batches(name: str, stream, most: int | None, give: bool) -> Iterator[pa.RecordBatch]:
    for x in read_shard(stream, most, give):
        yield status_batch(name, x, None, None, None) if isinstance(x, list) else status_batch(name, [None], *x)


class Shards(InputPartition):
    """Shards of one task: name and size of each."""

    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(None)
        self.files = files


class ShardReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.mode = options["path"], options.get("give", "records")
        self.most = int(options["most"]) if options.get("most") else None

    def partitions(self) -> list[Shards]:
        store, path, _ = store_of(self.folder)
        infos = store.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        files = sorted((i.path, i.size) for i in infos if i.is_file and i.path.endswith(".gz"))
        parts, size = [[]], 0
        for name, n in files:
            if parts[-1] and size + n > TASK_BYTES:
                parts.append([])
                size = 0
            parts[-1].append((name, n))
            size += n
        return [Shards(p) for p in parts]

    def read(self, partition: Shards) -> Iterator[pa.RecordBatch]:
        store, _, before = store_of(self.folder)
        for path, size in partition.files:
            if self.mode == "names":
                yield status_batch(before + path, [None], None, None, size)
                continue
            with store.open_input_stream(path, compression=None) as stream:
                yield from shard_batches(before + path, stream, self.most, self.mode == "records")


class ShardSource(DataSource):
    """Format `gzip_shards`: a row for each record (file, record) of the *.gz shards in a folder and those inside it that can be read to their end, and after these a row
    for each shard with a null record: reason (null if it can be read), records and bytes, how much was read of it.

    Options: path; most, the first records of a shard that are read; give: `records`, `health` for the rows of shards only, or `names` for these
    without reading anything, bytes being the size.
    """

    @classmethod
    def name(cls) -> str:
        return "gzip_shards"

    def schema(self) -> str:
        return "file string, record string, reason string, records long, bytes long"

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options)
