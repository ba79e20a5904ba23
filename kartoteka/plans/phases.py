"""The six phases from documents to persons and events, over injected adapters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import cut
from kartoteka.config import Settings
from kartoteka.functions import text as X
from kartoteka.operators import classify as C
from kartoteka.operators import images, ocr, patterns
from kartoteka.operators.bloom import BloomFilter
from kartoteka.operators.extract import extract
from kartoteka.plans.pipeline import Phase, PhaseOutput, Pipeline
from kartoteka.schemas import BOX, ENTITY, PHASES
from kartoteka.sources.adapters import Read, Render, read_words, render_pages
from kartoteka.sources.resolution import ResolutionStore
from kartoteka.sources.stores import DeadLetters, PhaseStore

_FAILED = "doc_id", "error_class", "message"


def _failed(rows: DataFrame, kind: str, message: F.Column | str) -> DataFrame:
    return rows.select(F.col("doc_id").cast("string"), F.lit(kind).alias("error_class"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def acquire(settings: Settings, render: Render) -> Phase:
    """Documents (``doc_id, content, source, source_url, warc_id, filename, error``) whose first page scores as Polish; equal contents are
    one document. Unreadable ones and those with an error fail, the rest is discarded."""

    def run(rows: DataFrame) -> PhaseOutput:
        once = rows.dropDuplicates(["doc_id"])
        pages = cut(render_pages(once, render))
        first = pages.where("page_num = 0").select("doc_id", X.lang_score(X.sample_text(F.col("text"))).alias("lang_score"))
        scored = cut(once.join(first, "doc_id", "left").withColumns({"lang_score": F.coalesce("lang_score", F.lit(0.0)), "acquired_at": F.current_timestamp()}))
        bad = pages.where("error IS NOT NULL").select("doc_id", "error").unionByName(once.where("error IS NOT NULL").select("doc_id", "error"))
        bad = bad.groupBy("doc_id").agg(F.min("error").alias("error"))
        fine = scored.join(bad.select("doc_id"), "doc_id", "left_anti")
        keep = F.col("lang_score") >= settings.lang_score_threshold
        return PhaseOutput(fine.where(keep), fine.where(~keep), _failed(bad, "AcquisitionError", F.col("error")))

    kind = "doc_id string, content binary, source string, source_url string, warc_id string, filename string, lang_score double, acquired_at timestamp"
    return Phase(PHASES[0], T.StructType.fromDDL(kind), run)


def classify(render: Render) -> Phase:
    """The type of each document by its first, middle and last page; only directories go on. Documents without content or pages are
    discarded, unreadable ones fail."""

    def run(rows: DataFrame) -> PhaseOutput:
        pages = cut(render_pages(rows, render))
        sampled = pages.where(C.sampled(F.col("page_num"), F.col("n_pages")))
        kinds = cut(C.classify(C.features(sampled)).select("doc_id", "doc_type", "confidence"))
        sizes = pages.where("page_num = 0").select("doc_id", C.sample_indices(F.col("n_pages")).cast("array<int>").alias("sample_page_indices"))
        kept = kinds.where("doc_type = 'directory'").join(sizes, "doc_id").withColumn("classified_at", F.current_timestamp())
        gone = kinds.where("doc_type <> 'directory'").select("doc_id").unionByName(pages.where("n_pages = 0").select("doc_id"))
        return PhaseOutput(kept, gone, _failed(pages.where("error IS NOT NULL"), "PhaseError", F.col("error")))

    kind = "doc_id string, doc_type string, confidence double, sample_page_indices array<int>, classified_at timestamp"
    return Phase(PHASES[1], T.StructType.fromDDL(kind), run)


def lay_out(store: PhaseStore, render: Render) -> Phase:
    """One row per entry image of each directory, whose content is looked up among the results of the first phase. Documents without
    content there, unreadable ones and those without an entry fail."""

    def run(rows: DataFrame) -> PhaseOutput:
        known = store.load(PHASES[0], T.StructType.fromDDL("doc_id string, content binary"))
        joined = cut(rows.where("doc_type = 'directory'").select("doc_id", "doc_type").join(known, "doc_id", "left"))
        pages = cut(render_pages(joined.where("content IS NOT NULL"), render))
        slices = cut(images.layout(pages.where("page_num IS NOT NULL")))
        ok = slices.join(joined.select("doc_id", "doc_type"), "doc_id").withColumn("analyzed_at", F.current_timestamp())
        lost = _failed(joined.where("content IS NULL"), "PhaseError", "no result of the first phase")
        bad = _failed(pages.where("error IS NOT NULL"), "PhaseError", F.col("error"))
        none = pages.where("error IS NULL").select("doc_id").distinct().join(slices.select("doc_id").distinct(), "doc_id", "left_anti")
        return PhaseOutput(ok, None, lost.unionByName(bad).unionByName(_failed(none, "PhaseError", "no entries found")))

    kind = f"doc_id string, doc_type string, slice_id string, page_num int, entry_index int, bbox {BOX}, image_bytes binary, analyzed_at timestamp"
    return Phase(PHASES[2], T.StructType.fromDDL(kind), run)


def recognise(settings: Settings, read: Read) -> Phase:
    """The text of each entry image, binarised, straightened and denoised before. Failed slices are left out; a document all of whose
    slices failed fails."""

    def run(rows: DataFrame) -> PhaseOutput:
        ready = images.prepare(rows).join(rows.select("slice_id", "doc_id"), "slice_id")
        words = cut(read_words(ready, read))
        done = ocr.outcomes(words.groupBy("doc_id", "slice_id").agg(F.bool_and(F.col("error").isNull()).alias("ok")))
        fine = words.where("error IS NULL").withColumns({"word": F.coalesce("word", F.lit("")), "conf": F.coalesce("conf", F.lit(-1))})
        texts = ocr.assemble(fine, settings.ocr.confidence_threshold).join(rows.select("slice_id", "doc_id", "page_num", "entry_index"), "slice_id")
        return PhaseOutput(texts.withColumn("processed_at", F.current_timestamp()), None, _failed(done.where("error IS NOT NULL"), "OCRError", F.col("error")))

    kind = f"doc_id string, slice_id string, page_num int, entry_index int, text string, confidence_score double, bboxes array<{BOX}>, needs_review boolean, processed_at timestamp"
    return Phase(PHASES[3], T.StructType.fromDDL(kind), run)


def extract_entities(settings: Settings, bloom: BloomFilter, client: Callable[[str], str] | None, cache_folder: str, strict: bool = True) -> Phase:
    """Entities of the entries' texts by cached patterns, then by the model, whose patterns are tried and kept in the cache's folder.
    With ``strict`` one unusable reply fails its document; else a document fails if all its entries did. Documents without any
    entity are passed on with none."""

    def run(rows: DataFrame) -> PhaseOutput:
        spark = rows.sparkSession
        cache = cut(patterns.load(spark, cache_folder))
        entities, failures, learned = extract(rows, cache, bloom, client, settings.extraction.bloom_hit_rate_threshold)
        patterns.save(cut(learned), cache_folder)
        counts = rows.where(X.strip(F.col("text")) != "").groupBy("doc_id").agg(F.count("*").alias("n"))
        bad = failures.groupBy("doc_id").agg(F.count("*").alias("failed"), F.min("error").alias("message")).join(counts, "doc_id", "left")
        fatal = cut(bad if strict else bad.where("failed >= n"))
        order = rows.select("slice_id", "page_num", "entry_index")
        made = entities.withColumn("slice_id", F.col("entity.slice_id")).join(order, "slice_id").join(fatal.select("doc_id"), "doc_id", "left_anti")
        return PhaseOutput(made.withColumn("extracted_at", F.current_timestamp()), None, _failed(fatal, "ExtractionError", F.col("message")))

    kind = f"doc_id string, slice_id string, page_num int, entry_index int, entity {ENTITY}, extracted_at timestamp"
    return Phase(PHASES[4], T.StructType.fromDDL(kind), run)


def resolve_entities(settings: Settings, resolution: ResolutionStore) -> Phase:
    """The person of each entity in the store, which gets the new persons, their events and the documents."""

    def run(rows: DataFrame) -> PhaseOutput:
        return PhaseOutput(resolution.add(rows, settings.resolution.fuzzy_match_threshold))

    kind = "doc_id string, entity_id string, person_db_id bigint, is_new boolean, merge_confidence double, resolved_at timestamp"
    return Phase(PHASES[5], T.StructType.fromDDL(kind), run)


@dataclass(frozen=True)
class Adapters:
    """The injected functions of a run."""

    render: Render
    read: Read
    client: Callable[[str], str] | None = None


def pipeline(spark: SparkSession, settings: Settings, adapters: Adapters, bloom: BloomFilter, folder: str) -> Pipeline:
    """All six phases, with their results, failures, pattern cache and resolution store below ``folder``. Its ``run`` takes the rows of
    :func:`kartoteka.sources.adapters.inputs`."""
    store, failures = PhaseStore(spark, f"{folder}/results"), DeadLetters(spark, f"{folder}/failures")
    phases = [
        acquire(settings, adapters.render), classify(adapters.render), lay_out(store, adapters.render), recognise(settings, adapters.read),
        extract_entities(settings, bloom, adapters.client, f"{folder}/patterns"), resolve_entities(settings, ResolutionStore(spark, f"{folder}/resolution")),
    ]
    return Pipeline(spark, phases, store, failures)
