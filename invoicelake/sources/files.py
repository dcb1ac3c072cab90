"""Scanned files: listing, fingerprints, image rows and the landing copy of the raw bytes."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.session import cut_lineage

# Accepted file types.
SUFFIXES = [".png", ".jpg", ".jpeg", ".pdf", ".tif", ".tiff"]

CHUNK = 1024 * 1024
TASK_BYTES = 128 * 1024 * 1024
FRAME_BYTES = 32 * 1024 * 1024
BATCH = 10_000
PRINTS = "path string, length long, sha256 string, error_message string"


def suffix_of(path: str | Column) -> Column:
    column = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(column, r"\.[^./]+$", 0))


def file_name_of(path: str | Column) -> Column:
    column = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(column, r"[^/]+$", 0)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, content) of the accepted files as Spark reads them.

    Every file is one value of 2 GB at most and Spark leaves empty files out; ``list_files`` with
    ``fingerprint_files`` has neither limit.
    """
    files = spark.read.format("binaryFile").load(folder)
    return files.filter(suffix_of("path").isin(SUFFIXES)).select("path", "length", "content")


def normal_path(path: str) -> str:
    """One spelling per file: local files as plain paths without escapes, others as they are."""
    if path.startswith("file:"):
        path = "/" + unquote(path[len("file:"):]).lstrip("/")
    return path.rstrip("/")


def with_normal_path(rows: DataFrame) -> DataFrame:
    """``normal_path`` for a column ``path``; a stream of files hands out escaped URIs, a listing plain paths."""
    plain = F.concat(F.lit("/"), F.url_decode(F.replace(F.regexp_replace("path", "^file:/+", ""), F.lit("+"), F.lit("%2B"))))
    return rows.withColumn("path", F.when(F.startswith("path", F.lit("file:")), plain).otherwise(F.col("path")))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    path = normal_path(path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition("://")
    host, _, name = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")  # the name is no URI and needs no escapes
    return system, f"{base.rstrip('/')}/{name}"


def _listed(folder: str, recursive: bool) -> Iterator[pd.DataFrame]:
    system, name = _open(folder)
    root, found = normal_path(folder), []
    for info in system.get_file_info(fs.FileSelector(name, recursive=recursive)):
        if info.type == fs.FileType.File or not recursive:
            found.append((f"{root}/{info.path[len(name):].lstrip('/')}", info.size, info.type != fs.FileType.File))
    for start in range(0, len(found), BATCH):
        yield pd.DataFrame(found[start:start + BATCH], columns=["path", "length", "folder"])


def _lister(recursive: bool):
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for folder in frame["path"]:
                yield from _listed(folder, recursive)
    return batches


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, length) of the accepted files below the folders; nothing is opened.

    The first level is listed by a task per folder, then every subfolder, with all below it, by a task of its own.
    """
    columns = "path string, length long, folder boolean"
    names = spark.createDataFrame([(f,) for f in folders], "path string").repartition(len(folders))
    top = cut_lineage(names.mapInPandas(_lister(False), columns))
    deeper = top.filter("folder").select("path").repartition("path").mapInPandas(_lister(True), columns)
    found = top.filter("NOT folder").unionByName(deeper)
    return found.filter(suffix_of("path").isin(SUFFIXES)).select("path", "length")


def fingerprint_content(files: DataFrame) -> DataFrame:
    """(path, length, sha256, error_message) of rows that carry their bytes."""
    return files.select("path", F.length("content").cast("long").alias("length"),
                        F.sha2("content", 256).alias("sha256"), F.lit(None).cast("string").alias("error_message"))


def _digest(path: str) -> str:
    system, name = _open(path)
    state = hashlib.sha256()
    with system.open_input_stream(name) as stream:
        while chunk := stream.read(CHUNK):
            state.update(chunk)
    return state.hexdigest()


def _digest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, length in zip(batch["path"], batch["length"]):
            try:
                rows.append((path, length, _digest(path), None))
            except Exception as problem:  # a bad file becomes a FAILED row, the others go on
                rows.append((path, length, None, str(problem)))
        yield pd.DataFrame(rows, columns=["path", "length", "sha256", "error_message"])


def fingerprint_files(listing: DataFrame) -> DataFrame:
    """Fingerprints of listed files, read in chunks inside the tasks; an unreadable file keeps its row.

    The files are spread by a hash of their path: the listing of one folder is a single partition.
    """
    return _spread(listing.select("path", "length")).mapInPandas(_digest_batches, PRINTS)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over tasks of about ``TASK_BYTES`` of file contents, and at least over the cores that are there."""
    size = rows.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(math.ceil(size[0] / TASK_BYTES), min(cores, size[1]), 1), "path")


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded pictures: (path, height, width, channels, data); a picture Spark cannot decode has NULL data."""
    rows = spark.read.format("image").option("dropInvalid", "false").load(folder).select("image.*")
    readable = F.col("height") > 0
    return rows.select(F.col("origin").alias("path"),
                       *[F.when(readable, F.col(c)).alias(n)
                         for c, n in [("height", "height"), ("width", "width"),
                                      ("nChannels", "channels"), ("data", "data")]])


def _content_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns, held, size = ["doc_id", "bronze_path", "content", "ingest_date", "error"], [], 0
    for batch in batches:
        for doc, kept, path, day in zip(batch["doc_id"], batch["bronze_path"], batch["path"], batch["ingest_date"]):
            content, error = None, None
            try:
                system, name = _open(path)
                with system.open_input_stream(name) as stream:
                    content = stream.read()
            except Exception as problem:  # the file went after it was hashed; the others go on
                error = str(problem) or type(problem).__name__
            held.append((doc, kept, content, day, error))
            size += len(content or b"")
            if size >= FRAME_BYTES:
                yield pd.DataFrame(held, columns=columns)
                held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


LANDED = "doc_id string, bronze_path string, content binary, error string, ingest_date date"


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The landed contents by doc_id. ``bronze_path`` names a row of this table, not a file of its own."""
    return _landing(spark, folder).filter("error IS NULL").drop("error")


def _landing(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(LANDED).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDED)


def land(registered: DataFrame, folder: str) -> DataFrame:
    """Keep the raw bytes of the ingested rows of a batch, one partition per ingest date; returns (doc_id, error) of files
    that could not be read any more.

    Only files that have not landed yet are read, in the tasks that write them, so a repeated batch changes nothing; no content
    is shuffled.
    """
    spark = registered.sparkSession
    kept = registered.filter("status = 'INGESTED'").select(
        "doc_id", "bronze_path", F.col("source_path").alias("path"), F.col("size_bytes").alias("length"),
        F.try_to_date(F.substring("ingested_at", 1, 10)).alias("ingest_date"))
    fresh = kept.join(landed(spark, folder).select("doc_id"), "doc_id", "left_anti")
    content = _spread(cut_lineage(fresh)).mapInPandas(
        _content_batches, "doc_id string, bronze_path string, content binary, ingest_date date, error string")
    content.write.mode("append").partitionBy("ingest_date").parquet(folder)
    failed = _landing(spark, folder).filter("error IS NOT NULL").groupBy("doc_id").agg(F.max("error").alias("error"))
    good = landed(spark, folder).select("doc_id")
    return failed.join(kept.select("doc_id"), "doc_id", "left_semi").join(good, "doc_id", "left_anti")


def _write_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            system, name = _open(path)
            system.create_dir(name.rpartition("/")[0], recursive=True)
            own = f"{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(own) as out:
                out.write(bytes(content))
            system.move(own, name)
        yield pd.DataFrame({"n": [len(batch)]})


def write_files(rows: DataFrame) -> int:
    """Write (path, content) rows as files inside the tasks; a task that runs again writes the same files."""
    return rows.select("path", "content").mapInPandas(_write_batches, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
