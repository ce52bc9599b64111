"""Archive admission: guards on members and whole archives, and their summary."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import fixed
from pagewright.functions.text import has_allowed_extension, zip_folder_name, zip_member_guard


def archive_guard(members: DataFrame, max_files: int = fixed.MAX_FILES,
                  max_total_size: int = fixed.MAX_TOTAL_SIZE,
                  blocked: Column | None = None) -> DataFrame:
    """Per archive: member count, total size and the reason it is rejected, if any.

    The count is checked before the size. Corrupt archives carry their error through. A
    ``blocked`` condition is counted in the same pass.
    """
    if "error" not in members.columns:
        members = members.withColumn("error", F.lit(None).cast("string"))
    count, size = F.col("files"), F.col("total_size")
    return (members.groupBy("zip_file")
            .agg(F.count("member").alias("files"),
                 F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_size"),
                 F.max("error").alias("_error"),
                 F.count_if(blocked if blocked is not None else F.lit(False)).alias("blocked"))
            .withColumn("error", F.when(F.col("_error").isNotNull(), F.col("_error"))
                        .when(count > max_files, F.concat(
                            F.lit("Archive contains too many files ("), count.cast("string"),
                            F.lit(f" > {max_files})")))
                        .when(size > max_total_size, F.concat(
                            F.lit("Archive too large when uncompressed ("), size.cast("string"),
                            F.lit(" bytes)"))))
            .drop("_error", *(["blocked"] if blocked is None else [])))


def admitted(members: DataFrame, max_file_size: int = fixed.MAX_FILE_SIZE,
             max_files: int = fixed.MAX_FILES, max_total_size: int = fixed.MAX_TOTAL_SIZE) -> DataFrame:
    """Members that pass both guards."""
    good = archive_guard(members, max_files, max_total_size).where("error is null").select("zip_file")
    return (members.where(F.col("member").isNotNull() & zip_member_guard("member", "file_size", max_file_size).isNull())
            .join(good, "zip_file", "left_semi"))


def extension_filter(files: DataFrame, name: str, include: str | None = None,
                     override: str | None = None) -> DataFrame:
    """Files with an allowed extension; a separate step, not part of admission."""
    return files.where(has_allowed_extension(name, include, override))


def extraction_summary(members: DataFrame, max_file_size: int = fixed.MAX_FILE_SIZE,
                       max_files: int = fixed.MAX_FILES,
                       max_total_size: int = fixed.MAX_TOTAL_SIZE) -> DataFrame:
    """Per archive: folder name, extracted and blocked members, error, success."""
    blocked = zip_member_guard("member", "file_size", max_file_size).isNotNull()
    ok = F.col("error").isNull()
    return (archive_guard(members, max_files, max_total_size, blocked)
            .select("zip_file", zip_folder_name("zip_file").alias("folder_name"),
                    ok.alias("success"),
                    F.when(ok, F.col("files") - F.col("blocked")).otherwise(0).alias("files_extracted"),
                    F.when(ok, F.col("blocked")).otherwise(0).alias("files_blocked"),
                    "error"))


def extraction_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count(F.lit(1)).alias("total_zips"),
                       F.count_if(F.col("success")).alias("successful_extractions"),
                       F.count_if(~F.col("success")).alias("failed_extractions"),
                       F.coalesce(F.sum("files_extracted"), F.lit(0)).alias("files_extracted"),
                       F.coalesce(F.sum("files_blocked"), F.lit(0)).alias("files_blocked"))
