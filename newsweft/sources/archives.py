"""Archives of past days, sheets of rows, and glossaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip, text

#: What an archive's name begins with, and the archive of each sheet.
ARCHIVE_PREFIX = "prod_"
ARCHIVES = {"prod": "archive_prod", "dev": "archive_dev"}


def archive_of(target: str) -> str:
    """The archive of a sheet; other names have none."""
    if target.strip() not in ARCHIVES:
        raise ValueError("the target sheet is prod or dev")
    return ARCHIVES[target.strip()]


def archive_files(files: DataFrame, kind: str) -> DataFrame:
    """Files of a kind that are not trashed and whose name begins as an archive's, by name."""
    return files.filter((F.col("kind") == kind) & ~F.col("trashed") & F.startswith("name", F.lit(ARCHIVE_PREFIX))).orderBy("name")


def read_archives(spark: SparkSession, folder: str, schema: str, pattern: str = f"{ARCHIVE_PREFIX}*") -> DataFrame:
    """Rows of all archives below a folder, with ``file``; unreadable files are left out."""
    got = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(folder)
    return got.withColumn("file", F.col("_metadata.file_name"))


def adopted(rows: DataFrame, target: str, flag: str = "k", exact: bool = False) -> DataFrame:
    """Rows of the target's archive that are adopted: ``a``, in any case unless ``exact``."""
    k = F.col(flag) if exact else F.lower(strip(F.col(flag)))
    return rows.filter((F.col("sheet") == archive_of(target)) & (k == "a"))


def glossary(cells: DataFrame, any_cell: bool = False) -> DataFrame:
    """``mm, en, body_ja, title_ja, ja`` of four positional columns: rows with a term, or with any cell; ``ja`` is the title's form, else the body's."""
    names = ("mm", "en", "body_ja", "title_ja")
    g = cells.select(*[text(F.col(c)).alias(n) for c, n in zip(cells.columns, names)])
    has = F.concat(*names) != "" if any_cell else F.concat("mm", "en") != ""
    return g.filter(has).withColumn("ja", F.when(F.col("title_ja") != "", F.col("title_ja")).otherwise(F.col("body_ja")))


def usable(full_text: Column) -> Column:
    return text(full_text) != ""


def pending(day: Column, final_score: Column) -> Column:
    """A day is there and no final score yet."""
    return (text(day) != "") & (text(final_score) == "")
