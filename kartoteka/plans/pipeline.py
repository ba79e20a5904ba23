"""Phases run one after the other over whole tables, with resume, failure records and a summary."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import cut
from kartoteka.config import Settings
from kartoteka.errors import PhaseError
from kartoteka.functions import text as X
from kartoteka.operators import classify as C
from kartoteka.sources.stores import DeadLetters, PhaseStore

OUTCOMES = ("processed", "skipped", "discarded", "failed")


@dataclass(frozen=True)
class PhaseOutput:
    """What a phase made of its input: results, ``doc_id`` of discarded documents, and failures (``doc_id, error_class, message``)."""

    ok: DataFrame
    discarded: DataFrame | None = None
    failed: DataFrame | None = None


@dataclass(frozen=True)
class Phase:
    """A named step. ``run`` takes the rows still to do; its results have the columns of ``schema``, ``doc_id`` among them."""

    name: str
    schema: T.StructType
    run: Callable[[DataFrame], PhaseOutput]


@dataclass
class Pipeline:
    """Phases over a store of results and one of failures. A document with a result is not run again; its result goes on to
    the next phase. Failed documents are tried again at the next run."""

    spark: SparkSession
    phases: Sequence[Phase]
    store: PhaseStore
    failures: DeadLetters
    counts: list[tuple[str, str, int]] = field(default_factory=list)

    def run(self, rows: DataFrame) -> DataFrame:
        """The last phase's results for ``rows``; the counts of all outcomes are kept for :meth:`summary`."""
        self.counts = []
        for phase in self.phases:
            if "doc_id" not in rows.columns:
                raise PhaseError(phase.name, "unknown", "input rows have no doc_id")
            ids = cut(rows.select("doc_id").distinct())
            before = self.store.completed(phase.name).join(ids, "doc_id", "left_semi")
            skipped = before.count()
            todo = self.store.todo(phase.name, rows)
            try:
                out = phase.run(todo)
                ok = cut(out.ok.select(*phase.schema.names))
                failed = cut(out.failed.select("doc_id", "error_class", "message", F.lit(None).cast("string").alias("traceback"))) if out.failed is not None else None
                if out.discarded is not None:
                    out = replace(out, discarded=cut(out.discarded.select("doc_id").distinct()))
            except Exception as e:  # noqa: BLE001 - what ends a phase fails its documents, not the run
                out = PhaseOutput(self.spark.createDataFrame([], phase.schema))
                ok, kind, why = out.ok, f"{type(e).__module__}.{type(e).__qualname__}", traceback.format_exc()
                failed = todo.select("doc_id").distinct().select("doc_id", F.lit(kind).alias("error_class"), F.lit(str(e)).alias("message"), F.lit(why).alias("traceback"))
            self.store.save(phase.name, ok)
            done = ok.select("doc_id").distinct().count()
            lost = 0
            if failed is not None:
                failed = cut(failed.join(_inputs(todo), "doc_id", "left").select(F.lit(phase.name).alias("phase"), "doc_id", "error_class", "message", "traceback", "input_data"))
                lost = failed.select("doc_id").distinct().count()
                if lost:
                    self.failures.record(failed)
            gone = out.discarded.select("doc_id").distinct().count() if out.discarded is not None else 0
            self.counts += [(phase.name, o, n) for o, n in zip(OUTCOMES, (done, skipped, gone, lost))]
            rows = self.store.load(phase.name, phase.schema).join(ids, "doc_id", "left_semi")
        return rows

    def summary(self) -> DataFrame:
        """``phase, processed, skipped, discarded, failed`` of the last run, in documents."""
        rows = self.spark.createDataFrame(self.counts, "phase string, outcome string, n bigint")
        return rows.groupBy("phase").pivot("outcome", list(OUTCOMES)).agg(F.sum("n"))


def _inputs(rows: DataFrame) -> DataFrame:
    """``doc_id, input_data``: one of each document's rows as JSON, without its bytes."""
    plain = [c for c, t in rows.dtypes if "binary" not in t]
    return rows.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.min(F.to_json(F.struct(*plain))).alias("input_data"))


def acquisition(settings: Settings, text: str = "text") -> Phase:
    """Documents of a table or reader (``doc_id``, text, anything else is ignored): language score of the first characters, and the
    language filter. Rows of one ``doc_id`` become one document; equal contents under two ids stay two."""

    def run(rows: DataFrame) -> PhaseOutput:
        scored = rows.select("doc_id", F.col(text).alias("text")).withColumn("lang_score", X.lang_score(X.sample_text(F.col("text"))))
        scored = cut(scored.dropDuplicates(["doc_id"]))
        keep = F.col("lang_score") >= settings.lang_score_threshold
        return PhaseOutput(scored.where(keep), scored.where(~keep))

    return Phase("phase1_acquisition", T.StructType.fromDDL("doc_id string, text string, lang_score double"), run)


def classification(text: str = "text") -> Phase:
    """Type of each document by the rules; only directories go on. Pages are parted by form feeds."""

    def run(rows: DataFrame) -> PhaseOutput:
        pages = rows.select("doc_id", "text", F.posexplode(F.split("text", "\f")).alias("page", "page_text"), F.size(F.split("text", "\f")).alias("n"))
        pages = pages.where(C.sampled(F.col("page"), F.col("n")))
        features = pages.select(
            "doc_id", C.entry_density(F.col("page_text")).alias("entry_density"), F.lit(1).alias("column_count"),
            F.lit(False).alias("table_structure"), C.has_keywords(F.col("page_text")).alias("keywords_present"),
        )
        kinds = cut(C.classify(features).select("doc_id", "doc_type", "confidence"))
        kept = kinds.where("doc_type = 'directory'").join(rows.select("doc_id", "text"), "doc_id")
        return PhaseOutput(kept, kinds.where("doc_type <> 'directory'"))

    return Phase("phase2_classification", T.StructType.fromDDL("doc_id string, doc_type string, confidence double, text string"), run)


def entries() -> Phase:
    """One slice per kept line of a document; documents without any fail."""

    def run(rows: DataFrame) -> PhaseOutput:
        lines = line_entries(rows, "doc_id", "text")
        none = rows.select("doc_id").join(lines.select("doc_id").distinct(), "doc_id", "left_anti")
        return PhaseOutput(lines, None, none.select("doc_id", F.lit("PhaseError").alias("error_class"), F.lit("no entries found").alias("message")))

    return Phase("phase3_layout", T.StructType.fromDDL("doc_id string, slice_id string, entry_index int, text string"), run)


def line_entries(rows: DataFrame, doc_id: str, text: str, least: int = 20) -> DataFrame:
    """``doc_id, slice_id, entry_index, text``: lines of at least ``least`` characters, numbered from 0 without the short ones."""
    kept = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.length(x) >= least)
    lines = rows.select(F.col(doc_id).alias("doc_id"), F.posexplode(kept).alias("entry_index", "text"))
    return lines.select("doc_id", X.slice_id(F.col("doc_id"), F.lit(0), F.col("entry_index")).alias("slice_id"), "entry_index", "text")
