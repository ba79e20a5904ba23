"""Phase results, failures and run outcomes as Parquet tables in a shared folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import path_exists
from kartoteka.errors import CheckpointError
from kartoteka.schemas import FAILURE, column_names


@dataclass(frozen=True)
class PhaseStore:
    """One folder per phase; each write is an own committed batch, so results of other documents stay."""

    spark: SparkSession
    folder: str

    def path(self, phase: str) -> str:
        return f"{self.folder.rstrip('/')}/phase={phase}"

    def save(self, phase: str, rows: DataFrame) -> None:
        """Append ``rows``, which have a ``doc_id``; of a document saved again the newest rows count."""
        rows.withColumn("_saved_at", F.current_timestamp()).write.mode("append").parquet(self.path(phase))

    def load(self, phase: str, schema: T.StructType) -> DataFrame:
        """The newest rows of each document; empty if the phase has none."""
        if not path_exists(self.spark, self.path(phase)):
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("_saved_at", T.TimestampType())])
        rows = self.spark.read.schema(full).parquet(self.path(phase))
        newest = rows.groupBy("doc_id").agg(F.max("_saved_at").alias("_saved_at"))
        return rows.join(newest, ["doc_id", "_saved_at"]).select(*schema.names)

    def completed(self, phase: str) -> DataFrame:
        """``doc_id`` of every document with a result."""
        return self.load(phase, T.StructType.fromDDL("doc_id string")).distinct()

    def todo(self, phase: str, rows: DataFrame) -> DataFrame:
        """Rows of documents without a result."""
        return rows.join(self.completed(phase), "doc_id", "left_anti")

    def clear(self, phase: str | None = None) -> None:
        """Delete the results of one phase, or of all."""
        try:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(phase) if phase else self.folder)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception as e:
            raise CheckpointError(f"cannot clear {phase or self.folder}: {e}") from e


@dataclass(frozen=True)
class DeadLetters:
    """Failures as JSON lines; of a phase and document the last one counts."""

    spark: SparkSession
    folder: str

    def record(self, failures: DataFrame) -> None:
        """Append failures with ``phase, doc_id, error_class, message`` and, if they have them, ``traceback`` and ``input_data``."""
        missing = {c: F.lit(None).cast("string") for c in ("traceback", "input_data") if c not in failures.columns}
        failures.withColumns(missing).select(F.current_timestamp().alias("timestamp"), *column_names(FAILURE)[1:]).write.mode("append").json(self.folder)

    def failures(self, phase: str | None = None) -> DataFrame:
        """The last failure of each phase and document, oldest first; malformed lines are left out."""
        if not path_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], FAILURE)
        rows = self.spark.read.schema(FAILURE).option("mode", "DROPMALFORMED").json(self.folder)
        return last_failures(rows if phase is None else rows.where(F.col("phase") == phase)).orderBy("timestamp")


def last_failures(rows: DataFrame) -> DataFrame:
    """The last row of each ``phase, doc_id`` by ``timestamp``; missing times come first."""
    pick = F.max_by(F.struct(*[c for c in rows.columns if c not in ("phase", "doc_id")]), F.coalesce("timestamp", F.timestamp_seconds(F.lit(0))))
    return rows.groupBy("phase", "doc_id").agg(pick.alias("r")).select("phase", "doc_id", "r.*")
