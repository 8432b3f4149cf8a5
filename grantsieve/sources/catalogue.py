"""Catalogue source: CSV to job rows."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.scalars import normalize_url
from ..functions.text import or_null, strip_space


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Files of the same header line, the first line that is not blank; one narrow job.

    What reaches the driver is a path per file, as Spark's own listing of files holds there.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    headers = lines.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [r["files"] for r in groups.orderBy(F.col("files")[0]).collect()]


def _read_one_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        # columns go by place: should a file's header differ from the first one's, it is refused
        .option("enforceSchema", False)
        .csv(paths)
    )
    if not df.columns:
        raise ValueError("the catalogue has no header row")
    if fv.CATALOGUE_URL not in df.columns:
        raise ValueError(
            f'the catalogue has no column "{fv.CATALOGUE_URL}"; found {df.columns}'
        )
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.monotonically_increasing_id().alias("ord"),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV with all-string columns, ``source_file`` and row order ``ord``.

    Quoted fields may span lines, so each file is one split and ``ord`` follows the row
    order inside a file. Order a catalogue of several files by ``source_file, ord``. Files
    with different headers are read by one scan for each of them and united by column name;
    a column that a file lacks is null there. Only the URL column must be in all of them.
    """
    groups = _files_by_header(spark, path)
    if len(groups) < 2:
        return _read_one_header(spark, path)
    parts = [_read_one_header(spark, [unquote(f) for f in files]) for files in groups]  # the names are URIs
    catalogue = parts[0]
    for p in parts[1:]:
        catalogue = catalogue.unionByName(p, allowMissingColumns=True)
    return catalogue


def job_rows(catalogue: DataFrame) -> DataFrame:
    """Job columns of a catalogue: normalised URL, stripped optional texts, blank -> null."""
    optional = [
        (
            or_null(strip_space(F.col(f"`{source}`")))
            if source in catalogue.columns
            else F.lit(None).cast("string")
        ).alias(name)
        for name, source in fv.CATALOGUE_OPTIONAL.items()
    ]
    order = [c for c in ("source_file", "ord") if c in catalogue.columns]
    return catalogue.select(
        *order, normalize_url(F.col(f"`{fv.CATALOGUE_URL}`")).alias("url"), *optional
    )


def newest_snapshot(spark: SparkSession, pattern: str) -> str | None:
    """Path of the newest landed snapshot, by name; null when none has landed.

    A snapshot is a file, or a folder of part files, whose name fits the last part of
    ``pattern`` (``*`` and ``?``). Only names are read.
    """
    glyphs = {"*": "[^/]*", "?": "[^/]"}
    name = "".join(glyphs.get(c, re.escape(c)) for c in pattern.rstrip("/").rpartition("/")[2])
    try:
        files = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    snapshot = F.regexp_extract("path", f"^(.*/{name})(?:/[^/]*)?$", 1)
    return files.agg(F.max(snapshot)).first()[0]


def payload_records(payload: Column) -> Column:
    """Number of records in a CSV payload: physical lines without the header, at least 0."""
    lines = F.size(F.split(strip_space(payload), r"\R|[\x1c-\x1e]"))
    return F.greatest(lines - 1, F.lit(0)).cast("bigint")

