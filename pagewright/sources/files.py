"""Scans of export folders and archives."""
from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.text import basename

MEMBER_SCHEMA = "zip_file string, member string, file_size long, error string"


def scan_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """(path, html): whole files below a folder; sort with ``sorted_files`` where order matters."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .text(folder, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")))


def scan_archives(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """(path, length, content) of the archives directly in a folder.

    Selecting only path and length never opens a file.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
            .select("path", "length", "content"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size) of all files below a folder, without reading them."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
            .select("path", F.col("length").alias("size")))


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows += [(path, i.filename, i.file_size, None) for i in z.infolist()] or [(path, None, None, None)]
            except zipfile.BadZipFile:
                rows.append((path, None, None, "Invalid or corrupted zip file"))
            except Exception as error:  # whatever else an archive does, the others go on
                rows.append((path, None, None, str(error) or type(error).__name__))
        out = pd.DataFrame(rows, columns=["zip_file", "member", "file_size", "error"])
        yield out.astype({"file_size": "Int64"})


def scan_zip_members(archives: DataFrame) -> DataFrame:
    """One row per archive member; an archive that cannot be read gives one error row, one
    without members a row without a member.

    ``archives`` carries (path, content). Archives are read one by one where they lie.
    """
    return archives.select("path", "content").mapInPandas(_members, MEMBER_SCHEMA)


def read_zip_members(archives: DataFrame, admitted: DataFrame) -> DataFrame:
    """(zip_file, member, content, error) of admitted members: extraction without local disk.

    A member that cannot be read (checksum, encryption, compression) has an error and no
    content; the others go on.

    The admitted names of an archive travel with it, so each archive is opened once. There
    are no more of them than the archive guard lets pass.
    """
    names = admitted.groupBy(F.col("zip_file").alias("path")).agg(F.collect_set("member").alias("names"))

    def read(batches):
        for pdf in batches:
            for path, content, wanted in zip(pdf["path"], pdf["content"], pdf["names"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(wanted):
                        body, why = None, None
                        try:
                            body = z.read(name)
                        except Exception as error:
                            why = str(error) or type(error).__name__
                        yield pd.DataFrame({"zip_file": [path], "member": [name], "content": [body], "error": [why]})

    return (archives.select("path", "content").join(names, "path")
            .mapInPandas(read, "zip_file string, member string, content binary, error string"))


# ---------------------------------------------------------------- folder layout

LAYOUT = r"(?:^|/)input/([^/]+)/([^/]+)/index\.html$"


def discover_spaces(files: DataFrame) -> DataFrame:
    """(export, folder): space folders with an index page inside ``Export-*`` folders."""
    return (files.where(F.col("path").rlike(LAYOUT))
            .select(F.regexp_extract("path", LAYOUT, 1).alias("export"),
                    F.regexp_extract("path", LAYOUT, 2).alias("folder"))
            .where(F.col("export").startswith("Export-")).distinct())


def list_exports(files: DataFrame) -> DataFrame:
    """First-level folder names below ``input``."""
    first = F.regexp_extract("path", r"(?:^|/)input/([^/]+)/", 1)
    return files.select(first.alias("export")).where("export <> ''").distinct()


def space_keys(files: DataFrame) -> DataFrame:
    """Keys of stored space documents: file names without ``.json``."""
    return (files.where(F.col("path").endswith(".json"))
            .select(F.regexp_replace(basename("path"), r"\.json$", "").alias("space_key")).distinct())
