"""Voice archives as a Spark data source: read in slices, written at offsets.

Reading makes as many tasks of a file as it has slices of bytes; the index is dealt out to them in
blocks, and a task reads its own blocks and their entries' media. Ids that occur twice are found by
grouping the index. Ids that are asked for are pushed into the reader, payloads are read and hashed
a piece at a time. Writing lets every task put its own rows' bytes and index records
in their places of one file, which is renamed when all are there.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from . import archive
from .archive import BLOCK_EXTRA, ENTRY_BYTES, FormatError, encode_count

ENTRY_SCHEMA = (
    "path string, entry_index long, ident long, ident_high long, codec string, channels long, rate long, duration double, has_seek boolean, trailer_kind long, "
    "media_bytes long, media_sha256 string, companion_bytes long, companion_sha256 string, error string"
)
PAYLOAD_SCHEMA = ENTRY_SCHEMA + ", media binary, companion binary"
INDEX_SCHEMA = "path string, entry_index long, ident long, ident_high long"
WRITTEN_SCHEMA = "entry_index long, entries long, ident long, ident_high long, wave_offset long, companion_offset long, duration float, trailer_kind long, media binary, companion binary, archive_bytes long"
SLICE_BYTES = 32 << 20
SMALL = 100_000  # repeated ids that are broadcast at most; they are counted
_BATCH_ROWS, _BATCH_BYTES = 1000, 4 << 20
_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def _held(fetch: archive.Fetch, start: int, size: int) -> archive.Fetch:
    """fetch, with a short entry's bytes read at once."""
    if size > archive.PIECE:
        return fetch
    held = fetch(start, size)
    return lambda at, n: held[at - start : at - start + n] if start <= at and at + n <= start + size else fetch(at, n)


@dataclass
class Slice(InputPartition):
    path: str
    length: int
    number: int
    of: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.slice_bytes = int(options.get("slice_bytes", SLICE_BYTES))
        self.payload, self.index = options.get("payload", "false") == "true", options.get("index", "false") == "true"
        idents = options.get("idents")
        self.wanted: set[int] | None = None if idents is None else {int(x) for x in idents.split(",") if x}

    def partitions(self) -> list[Slice]:
        from pyarrow import fs

        system, inner = file_system(self.path)
        scheme = self.path.removesuffix(inner) if "://" in self.path and not self.path.startswith("file:") else ""
        info = system.get_file_info(inner)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=False))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, self.glob) and not f.base_name.startswith(("_", ".")))
        slices = ((scheme + path, size, max(1, -(-size // self.slice_bytes))) for path, size in files)
        return [Slice(path, size, number, of) for path, size, of in slices for number in range(of)]

    def _rows(self, part: Slice) -> Iterator[dict]:
        system, inner = file_system(part.path)
        with system.open_input_file(inner) as file:
            fetch = lambda at, n: file.read_at(n, at)
            try:
                many, first = archive.index_place(fetch, part.length)
            except FormatError as e:
                if part.number == 0:
                    yield {"path": part.path, "error": str(e)}
                return
            header = first + ENTRY_BYTES * many + 2
            for i, ident, high, offset, size, c_offset, c_size, reserved in archive.part_entries(fetch, many, first, part.number, part.of):
                if self.wanted is not None and ident not in self.wanted:
                    continue
                row = {"path": part.path, "entry_index": i, "ident": ident, "ident_high": high}
                try:
                    if reserved:
                        raise FormatError("reserved field set")
                    near = _held(fetch, offset, size) if header <= offset <= part.length - size else fetch
                    row |= archive.occurrence(near, part.length, offset, size, c_offset, c_size, header)
                    if self.payload:
                        row |= {"media": near(offset + 4, size - BLOCK_EXTRA), "companion": near(c_offset, c_size)}
                except FormatError as e:
                    row["error"] = str(e)
                yield row

    def _index(self, part: Slice) -> Iterator[pa.RecordBatch]:
        """Ids of a slice's entries, without their media; an index that can't be read has none."""
        system, inner = file_system(part.path)
        with system.open_input_file(inner) as file:
            fetch = lambda at, n: file.read_at(n, at)
            try:
                many, at = archive.index_place(fetch, part.length)
            except FormatError:
                return
            for first, raw in archive.index_blocks(fetch, many, at, part.number, part.of):
                ids = np.frombuffer(raw, "<u4").reshape(-1, 10)[:, :2].astype(np.int64)
                numbers = np.arange(first, first + len(ids))
                if self.wanted is not None:
                    asked = np.isin(ids[:, 0], [x for x in self.wanted if 0 <= x < 1 << 32])
                    ids, numbers = ids[asked], numbers[asked]
                columns = [pa.array([part.path] * len(ids), pa.string()), pa.array(numbers), pa.array(ids[:, 0]), pa.array(ids[:, 1])]
                yield pa.record_batch(columns, [c.split()[0] for c in INDEX_SCHEMA.split(", ")])

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if self.index:
            yield from self._index(partition)
            return
        fields = [c.split() for c in (PAYLOAD_SCHEMA if self.payload else ENTRY_SCHEMA).split(", ")]
        schema = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
        held: list[dict] = []
        size = 0
        for row in self._rows(partition):
            held.append(row)
            size += len(row.get("media", b"")) + len(row.get("companion", b""))
            if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


class PushedArchiveReader(ArchiveReader):
    """Takes ids that are asked for by equality or a list into the reader; used if the session allows it."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("ident",):
                asked = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted = asked if self.wanted is None else self.wanted & asked
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    rows: int
    bytes: int
    entries: int  # of the whole archive, 0 if the task had no row
    archive_bytes: int


class ArchiveWriter(DataSourceArrowWriter):
    """Writes rows of WRITTEN_SCHEMA into path + '.partial', each at its offset, so that a task that runs twice writes the same bytes twice."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        system, self.path = file_system(options["path"])
        if system.type_name != "local":
            raise ValueError("archives are written at offsets, so path has to name a folder that all machines mount (file:)")
        if os.path.exists(self.path) and not overwrite:
            raise FileExistsError(self.path)
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        with open(self.path + ".partial", "wb"):
            pass

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        rows = size = entries = whole = 0
        fd = os.open(self.path + ".partial", os.O_WRONLY)
        try:
            for batch in iterator:
                for r in batch.to_pylist():
                    companion = r["companion"] or b""
                    block = struct.pack("<I", len(r["media"])) + r["media"] + struct.pack("<fI", r["duration"], r["trailer_kind"]) + companion
                    self._put(fd, block, r["wave_offset"])
                    entries, whole = r["entries"], r["archive_bytes"]
                    first = 10 + len(encode_count(entries)) + ENTRY_BYTES * r["entry_index"]
                    index = struct.pack("<10I", r["ident"], r["ident_high"], r["wave_offset"], 0, len(r["media"]) + BLOCK_EXTRA, 0, r["companion_offset"], 0, len(companion), 0)
                    self._put(fd, index, first)
                    rows, size = rows + 1, size + len(block) + len(index)
            os.fsync(fd)
        finally:
            os.close(fd)
        return Written(rows, size, entries, whole)

    @staticmethod
    def _put(fd: int, data: bytes, at: int) -> None:
        view = memoryview(data)
        while view:
            n = os.pwrite(fd, view, at)
            view, at = view[n:], at + n

    def commit(self, messages: list[Written | None]) -> None:
        """Adds the head and renames, if every entry and byte has been written."""
        done = [m for m in messages if m is not None and m.rows]
        entries, whole = (done[0].entries, done[0].archive_bytes) if done else (0, 13)
        head = archive.MAGIC + struct.pack("<IH", archive.VERSION, 0) + encode_count(entries)
        if sum(m.rows for m in done) != entries or len(head) + sum(m.bytes for m in done) + 2 != whole:
            raise RuntimeError(f"{sum(m.rows for m in done)} of {entries} entries written, {len(head) + sum(m.bytes for m in done) + 2} of {whole} bytes")
        fd = os.open(self.path + ".partial", os.O_WRONLY)
        try:
            self._put(fd, head, 0)
            self._put(fd, bytes(2), len(head) + ENTRY_BYTES * entries)
            os.fsync(fd)
        finally:
            os.close(fd)
        os.replace(self.path + ".partial", self.path)

    def abort(self, messages: list[Written | None]) -> None:
        if os.path.exists(self.path + ".partial"):
            os.remove(self.path + ".partial")


class ArchiveSource(DataSource):
    """format("voice_archive"): options path, glob, slice_bytes, payload (adds media and companion), index (ids alone), idents, push.

    A row knows nothing of other entries; read_archives marks ids that occur twice.
    """

    @classmethod
    def name(cls) -> str:
        return "voice_archive"

    def schema(self) -> str:
        if self.options.get("index", "false") == "true":
            return INDEX_SCHEMA
        return PAYLOAD_SCHEMA if self.options.get("payload", "false") == "true" else ENTRY_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PushedArchiveReader if self.options.get("push", "false") == "true" else ArchiveReader)(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options), overwrite)


def read_archives(spark: SparkSession, path: str, wanted: set[int] | None = None, glob: str = "*", slice_bytes: int = SLICE_BYTES, payload: bool = False) -> DataFrame:
    """One row an archive entry, of the wanted ids if given; entries that can't be used have an error
    instead of media columns, and an archive whose index can't be read one row with an error.

    A file is read by as many tasks as it has slices of slice_bytes. Filters on `ident` by equality
    or list go into the reader if spark.sql.python.filterPushdown.enabled is set. Ids that an
    archive has twice are looked for in its index when this is called; all but the first are errors.
    """
    spark.dataSource.register(ArchiveSource)
    options = {"glob": glob} | ({} if wanted is None else {"idents": ",".join(map(str, sorted(wanted)))})
    reader = spark.read.format("voice_archive").options(**options).option("slice_bytes", slice_bytes).option("payload", str(payload).lower())
    entries = reader.option("push", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).load(path)
    key = ["path", "ident", "ident_high"]
    index = spark.read.format("voice_archive").options(**options).option("index", "true").load(path)
    again = index.groupBy(*key).agg(F.count("*").alias("__n"), F.min("entry_index").alias("__first")).where("__n > 1").drop("__n")
    many = again.limit(SMALL + 1).count()
    if not many:
        return entries
    late = F.coalesce(F.col("entry_index") > F.col("__first"), F.lit(False)) & ~F.col("error").eqNullSafe("reserved field set")
    judged = {"error": F.when(late, "repeated id").otherwise(F.col("error"))}
    kept = [F.col(c) if c in (*key, "entry_index") else judged.get(c, F.when(~late, F.col(c))).alias(c) for c in entries.columns]
    return entries.join(F.broadcast(again) if many <= SMALL else again, key, "left").select(*kept)


def skipped(entries: DataFrame) -> DataFrame:
    """(path, error, n): how many entries of each archive can't be used, and why; the archive itself counts as one if its index can't be read."""
    return entries.where(F.col("error").isNotNull()).groupBy("path", "error").agg(F.count("*").alias("n"))


def write_placed(placed: DataFrame, path: str, mode: str) -> None:
    """Writes rows with the columns of WRITTEN_SCHEMA, in as many tasks as they have partitions."""
    placed.sparkSession.dataSource.register(ArchiveSource)
    columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in WRITTEN_SCHEMA.split(", ")]
    placed.select(*columns).write.format("voice_archive").mode(mode).save(path)


def write_archive(items: DataFrame, path: str, order: str, force: bool = False) -> None:
    """Writes items (ident, ident_high, media, companion, duration, trailer_kind) as one archive, in order, and verifies it.

    Offsets come from prefix sums of sizes; payloads go from the tasks that hold them to their
    places in the file. Afterwards the archive is read in slices, and the number of entries and
    each payload's SHA-256 must be those of items; else the file is removed and an error raised.
    """
    spark = items.sparkSession
    sized = items.withColumns({"companion": F.coalesce("companion", F.lit(b"")), "media_bytes": F.length("media").cast("long")}).withColumn("companion_bytes", F.length("companion").cast("long"))
    key = ["ident", "ident_high"]
    if sized.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError("an id is repeated")
    placed = archive.layout(sized.select(*dict.fromkeys([*key, order, "media_bytes", "companion_bytes"])), order)  # sizes alone are put in order
    if placed.where(~F.col("fits")).limit(1).count():
        raise ValueError("the archive would be longer than 4 GiB")
    # dealt out by number, as small rows that adaptive execution puts together would be written by one task
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = placed.repartition(parts, *key).join(sized.select(*key, "media", "companion", "duration", "trailer_kind").repartition(parts, *key), key)
    write_placed(whole, path, "overwrite" if force else "append")
    back = read_archives(spark, path)
    source = sized.select(*key, F.sha2("media", 256).alias("a"), F.sha2("companion", 256).alias("b"))
    wrong = source.join(back, key, "full_outer").where(~(F.col("a").eqNullSafe(F.col("media_sha256")) & F.col("b").eqNullSafe(F.col("companion_sha256")))).count()
    if wrong:
        os.remove(file_system(path)[1])
        raise RuntimeError(f"{wrong} entries differ from what was to be written")
