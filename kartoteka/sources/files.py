"""Documents from folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kartoteka.errors import AcquisitionError
from kartoteka.functions.text import content_id


def local_documents(spark: SparkSession, folder: str, pattern: str = "*.pdf", missing: str = "error") -> DataFrame:
    """``doc_id, path, filename, content, length, acquired_at`` of the files right in ``folder``. Files are listed and read by the
    executors; order by ``path`` if the order matters. A missing folder is an error, or with ``missing="empty"`` no rows."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    except AnalysisException as e:
        if missing != "empty":
            raise AcquisitionError("phase1_acquisition", "unknown", f"no folder {folder}") from e
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    return files.select(
        content_id(F.col("content")).alias("doc_id"), "path", F.element_at(F.split("path", "/"), -1).alias("filename"), "content", "length", F.current_timestamp().alias("acquired_at")
    )


def surname_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``name``: the non-blank lines of text files."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")
