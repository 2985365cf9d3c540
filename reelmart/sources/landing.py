"""Scans of landed JSON with lineage from the path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.functions.scalars import iso_date, iso_timestamp
from reelmart.operators.dedup import newest_per
from reelmart.schemas import AUDIT, PAYLOADS
from reelmart.session import for_small_files, small_side

# The parts of a landing path that carry lineage.
DATE_IN_PATH = r"ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})"
RUN_IN_PATH = r"run_id=([^/]+)"
MEDIA_IN_PATH = r"media_id=([^/]+)"
PAGE_IN_PATH = r"page=([0-9]+)"

SOURCE = "_source_file"
CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, schema: str):
    # recursiveFileLookup lists folders in parallel on the executors and keeps
    # partition discovery from replacing the payload's own media_id.
    return (
        for_small_files(spark).read.schema(f"{schema}, {CORRUPT} string")
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_landed(
    spark: SparkSession,
    base: str,
    dataset: str,
    ingestion_dates: list[str] | None = None,
    optional: bool = False,
) -> DataFrame:
    """Typed scan of one dataset, an array file giving one row per element.

    ``ingestion_dates`` restricts the folders that are listed at all; a date without a folder
    has no rows. A missing optional dataset (A9) gives an empty DataFrame of the same schema.
    """
    schema = PAYLOADS[dataset]
    rows = _scanned(_reader(spark, schema).json, f"{base.rstrip('/')}/{dataset}", ingestion_dates, optional)
    if rows is None:
        return spark.createDataFrame([], f"{schema}, {CORRUPT} string, {SOURCE} string")
    return rows.withColumn(SOURCE, F.col("_metadata.file_path"))


def _scanned(
    load: Callable[[str], DataFrame], root: str, ingestion_dates: list[str] | None, optional: bool = False
) -> DataFrame | None:
    """The scan of a dataset's folder, or of those date folders of it that exist; None if there is nothing to scan.

    Of a list of paths none may be missing, a pattern takes what there is. Only a dataset
    without its own folder is missing, which is an error unless it is optional.
    """

    def found(path: str) -> DataFrame | None:
        try:
            return load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(error)
            return None

    missing: list[AnalysisException] = []
    rows = found(f"{root}/ingestion_date={{{','.join(ingestion_dates)}}}" if ingestion_dates else root)
    if rows is None and (not ingestion_dates or found(root) is None) and not optional:
        raise missing[-1]
    return rows


def is_broken(landed: DataFrame) -> Column:
    """Whether a landed row stands for a file that does not parse.

    Such a row has no payload; naming one payload field keeps the reader from refusing a
    scan of nothing but the broken text.
    """
    return F.col(CORRUPT).isNotNull() & F.col(landed.columns[0]).isNull()


def readable(landed: DataFrame) -> DataFrame:
    """Landed rows without those of broken files and without their text column."""
    return landed.filter(~is_broken(landed)).drop(CORRUPT) if CORRUPT in landed.columns else landed


def quarantined(landed: DataFrame) -> DataFrame:
    """The rows of files that do not parse, with the file and its text."""
    return landed.filter(is_broken(landed)).select(SOURCE, CORRUPT)


def read_audits(spark: SparkSession, path: str) -> DataFrame:
    """Audit records of one stage; unlike the landing they are read with all their fields declared."""
    rows = (
        spark.read.schema(AUDIT).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    )
    return rows.withColumns(
        {"_modified_at": F.col("_metadata.file_modification_time"), "_audit_file": F.col("_metadata.file_path")}
    )


def successful_runs(audits: DataFrame) -> DataFrame:
    """A1: (run_id, ingested_at) of the runs that succeeded, one row per run."""
    runs = audits.filter(F.col("status") == "SUCCESS").select(
        "run_id", iso_timestamp(F.col("start_ts")).alias("ingested_at")
    )
    return newest_per(runs, ["run_id"], [F.desc_nulls_last("ingested_at")])


def require_runs(runs: DataFrame) -> DataFrame:
    """Fail when no run succeeded."""
    if runs.isEmpty():
        raise ValueError("no successful ingestion run found")
    return runs


def path_part(source: Column, pattern: str) -> Column:
    """A part of a file path as it was written, '' where the path has none.

    Paths come as URIs, and partition folders escape special characters on top of that, so
    a part is decoded twice; a plus sign stands for itself. What is no valid code stays.
    """
    part = F.regexp_extract(source, pattern, 1)
    for _ in range(2):
        plain = F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
        part = F.when(F.contains(part, F.lit("%")), F.coalesce(plain, part)).otherwise(part)
    return part


def lineage(landed: DataFrame, media_in_path: bool = True) -> DataFrame:
    """Ingestion date, run and media named by the path; '' where it names none."""
    source = F.col(SOURCE)
    columns = {
        "ingestion_date": iso_date(F.regexp_extract(source, DATE_IN_PATH, 1)),
        # never NULL, and known to be: a join on it then adds no second evaluation as null check
        "run_id": F.coalesce(path_part(source, RUN_IN_PATH), F.lit("")),
    }
    if media_in_path:
        columns["media_id_from_path"] = path_part(source, MEDIA_IN_PATH)
    return landed.withColumns(columns)


def rows_of_runs(landed: DataFrame, runs: DataFrame, media_in_path: bool = True) -> DataFrame:
    """C1 + D1: rows landed by successful runs, with the run's ingested_at.

    Everything a failed or unaudited run left behind disappears here. The list of
    runs is broadcast while a count shows that it is small.
    """
    return lineage(landed, media_in_path).join(small_side(runs), "run_id")


def landed_objects(spark: SparkSession, base: str, dataset: str, ingestion_dates: list[str] | None = None) -> DataFrame:
    """One row per landed file with its run, media, page, records and whether it is broken.

    The file list comes from a scan that reads no content; files without rows, such
    as an empty last page, are only known from it. Both scans name files alike. A file
    that does not parse has no records and counts as broken.
    """
    reader = for_small_files(spark).read.format("binaryFile").option("recursiveFileLookup", True)
    scan = _scanned(reader.load, f"{base.rstrip('/')}/{dataset}", ingestion_dates)
    files = scan.select(F.col("_metadata.file_path").alias(SOURCE)) if scan is not None else spark.createDataFrame([], f"{SOURCE} string")
    landed = read_landed(spark, base, dataset, ingestion_dates)
    broken = is_broken(landed)
    counted = landed.groupBy(SOURCE).agg(F.count_if(~broken).alias("records"), F.max(broken).alias("broken"))
    found = files.join(counted, SOURCE, "left").withColumns({
        "records": F.coalesce("records", F.lit(0).cast("long")),
        "broken": F.coalesce("broken", F.lit(False)),
        "endpoint": F.lit(dataset),
    })
    named = lineage(found).withColumnRenamed("media_id_from_path", "media_id")
    return named.withColumn("page", F.regexp_extract(SOURCE, PAGE_IN_PATH, 1).try_cast("long"))
