"""Zip archives as a data source: directories are listed and members read by ranged reads."""
from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MEMBERS = ("zip_file string, archive_size long, member string, file_size long, packed_size long, "
           "place long, error string")
BODIES = "zip_file string, member string, content binary, error string"
ROWS = 8192            # members of one batch
BUFFER = 1 << 16       # bytes read at once
BATCH_BYTES = 1 << 23  # content handed on at once
READ_BYTES = 1 << 27   # packed bytes, or ...
READ_FILES = 20_000    # ... members that one task reads, about
LIST_BYTES = 1 << 30   # archives of so many bytes, or ...
LIST_FILES = 200       # ... so many archives are listed by one partition


def why(error: Exception) -> str:
    return "Invalid or corrupted zip file" if isinstance(error, zipfile.BadZipFile) else str(error) or type(error).__name__


class Ranged(io.RawIOBase):
    """A file of Arrow's that fails as Python's do where a place before its start is sought."""

    def __init__(self, opened):
        self.opened = opened

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.opened.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0, self.opened.tell(), self.opened.size())[whence]
        if place < 0:
            raise OSError("a place before the start")
        return self.opened.seek(place)

    def readinto(self, buffer) -> int:
        data = self.opened.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.opened.close()
        super().close()


def open_archive(path: str):
    """A seekable file, of which only what is asked for is read."""
    system, place = fs.FileSystem.from_uri(path)
    return io.BufferedReader(Ranged(system.open_input_file(place)), BUFFER)


def directory(path: str, size: int, opened) -> Iterator[tuple]:
    """Rows of ``MEMBERS`` from the directory at the end of an archive (ZIP64 too)."""
    try:
        with zipfile.ZipFile(opened) as archive:
            found = archive.infolist()
    except Exception as error:  # whatever else an archive does, the others go on
        yield (path, size, None, None, None, None, why(error))
        return
    if not found:
        yield (path, size, None, None, None, None, None)
    for member in found:
        yield (path, size, member.filename, member.file_size, member.compress_size, member.header_offset, None)


class Archives(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = options["path"], options.get("pattern", "*.zip")

    def partitions(self) -> list[Archives]:
        """Archives directly in the folder, dealt out by size and number; none is opened."""
        system, place = fs.FileSystem.from_uri(self.folder)
        prefix = self.folder.rstrip("/")
        found = sorted((f"{prefix}/{f.base_name}", f.size) for f in system.get_file_info(fs.FileSelector(place))
                       if f.is_file and fnmatch.fnmatchcase(f.base_name, self.pattern))
        parts, held, size = [], [], 0
        for file in found:
            if held and (len(held) >= LIST_FILES or size + file[1] > LIST_BYTES):
                parts.append(Archives(held))
                held, size = [], 0
            held.append(file)
            size += file[1]
        return [*parts, Archives(held)]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in MEMBERS.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in MEMBERS.split(", ")]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for path, size in partition.files:
            try:
                opened = open_archive(path)
            except Exception as error:
                rows.append((path, size, None, None, None, None, why(error)))
                continue
            with opened:
                for row in directory(path, size, opened):
                    rows.append(row)
                    if len(rows) >= ROWS:
                        yield batch()
                        rows = []
        yield batch()


class ZipSource(DataSource):
    """``spark.read.format("zip_members").option("pattern", "*.zip").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)


def scan_members(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """One row per member of the archives directly in a folder, with the place of its header.

    Only the directory at the end of each archive is read, so the size of archives does not
    matter. One that cannot be read gives one row with an error, an empty one a row without a
    member. A folder without archives gives no rows. The folder is one that Arrow's file systems
    open (local or shared paths and the usual object stores).
    """
    spark.dataSource.register(ZipSource)
    return spark.read.format("zip_members").option("pattern", pattern).load(folder)


def scan_archives(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """(zip_file, archive_size, members, error) of each archive, from its directory alone."""
    return (scan_members(spark, folder, pattern).groupBy("zip_file", "archive_size")
            .agg(F.count("member").alias("members"), F.max("error").alias("error")))


def _bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split(" ")[0] for c in BODIES.split(", ")]
    rows, size = [], 0
    last, opened, archive, places, broken = None, None, None, {}, None
    for batch in batches:
        for path, member, place in zip(batch["zip_file"], batch["member"], batch["place"]):
            if path != last:
                if opened is not None:
                    opened.close()
                last, opened, archive, broken = path, None, None, None
                try:
                    opened = open_archive(path)
                    archive = zipfile.ZipFile(opened)
                    places = {i.header_offset: i for i in archive.infolist()}
                except Exception as error:
                    broken = why(error)
            body, error = None, broken
            if archive is not None:
                try:
                    body = archive.read(places[place])
                except Exception as failed:  # checksum, encryption, compression
                    error = str(failed) or type(failed).__name__
            rows.append((path, member, body, error))
            size += len(body or b"")
            if size >= BATCH_BYTES or len(rows) >= ROWS:
                yield pd.DataFrame(rows, columns=names)
                rows, size = [], 0
    yield pd.DataFrame(rows, columns=names)
    if opened is not None:
        opened.close()


def read_members(members: DataFrame) -> DataFrame:
    """(zip_file, member, content, error) of the given members, each read by its place.

    Members are dealt out by archive and place, in as many parts as their packed bytes need, so a
    large archive is read by many tasks, each of which reads its directory and the ranges of its
    own members. Two members of one name
    are two rows. A member that cannot be read has an error and no content; the others go on.
    """
    wanted = members.where("member IS NOT NULL").select("zip_file", "member", "place", "packed_size")
    n, size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum("packed_size"), F.lit(0))).first()
    # a number of its own: rows without bodies are small, so that parts would be put together again
    parts = max(members.sparkSession.sparkContext.defaultParallelism, size // READ_BYTES, n // READ_FILES)
    return wanted.drop("packed_size").repartitionByRange(parts, "zip_file", "place").sortWithinPartitions("zip_file", "place").mapInPandas(_bodies, BODIES)
