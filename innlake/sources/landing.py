"""CSV landing files: reading, cleaning, refusing malformed files, listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from innlake.constants import LANDING_FOLDERS, NULL_TOKENS
from innlake.sources.schemas import RAW_COLUMNS, RAW_SCHEMAS

CORRUPT = "_corrupt"
# refused files up to this number are broadcast as a list of paths
MAX_BROADCAST_FILES = 100_000


def csv_options(multiline: bool = True) -> dict[str, str]:
    """One header line, comma, optional double quotes, blanks around fields cut.

    Quoted line breaks need whole-file reading; a feed known to have none can
    turn ``multiline`` off, and Spark then splits large files over tasks.
    """
    return {
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "enforceSchema": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def csv_schema(domain: str) -> T.StructType:
    return T.StructType([*RAW_SCHEMAS[domain].fields, T.StructField(CORRUPT, T.StringType())])


def folder(landing: str, domain: str) -> str:
    return f"{landing.rstrip('/')}/{LANDING_FOLDERS[domain]}"


def with_file(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_file_time"),
    )


def read_csv(spark: SparkSession, landing: str, domain: str, multiline: bool = True) -> DataFrame:
    """All files of a domain as they are, with the malformed-record column."""
    reader = spark.read.schema(csv_schema(domain)).options(**csv_options(multiline))
    return with_file(reader.csv(folder(landing, domain)))


def counted_files(rows: DataFrame) -> list[Row]:
    """Rows and records of the wrong width of every file with a row: a line for each file of a batch, whatever its rows."""
    return rows.groupBy("_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(CORRUPT).alias("bad_records")).collect()


def accepted_rows(rows: DataFrame, refused: DataFrame, n_refused: int) -> DataFrame:
    """Rows of files without a malformed record; one bad record refuses its file."""
    if n_refused:
        paths = refused.select("_file")
        if n_refused <= MAX_BROADCAST_FILES:
            paths = F.broadcast(paths)
        rows = rows.join(paths, "_file", "left_anti")
    return rows.drop(CORRUPT)


def clean(rows: DataFrame, domain: str) -> DataFrame:
    """Null tokens become NULL."""
    columns = RAW_COLUMNS[domain]
    return rows.withColumns({c: F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in columns})


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """Path, size and time of every landing file; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(landing).select("path", "length", "modificationTime")
