"""Persons, events and sources as versions of three Parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.cluster import cut, path_exists
from kartoteka.functions import text as X
from kartoteka.operators import resolve as R
from kartoteka.schemas import EVENTS, PERSONS, SOURCES

RESULT = "doc_id string, entity_id string, person_db_id bigint, is_new boolean, merge_confidence double, resolved_at timestamp"
TABLES = {"persons": PERSONS, "events": EVENTS, "sources": SOURCES}


@dataclass(frozen=True)
class ResolutionStore:
    """Each batch writes the next version of all tables and then its mark; readers take the last marked version, so a run that ends
    halfway changes nothing."""

    spark: SparkSession
    folder: str

    def version(self) -> int:
        """The last complete version, 0 for none."""
        n = 0
        while path_exists(self.spark, f"{self.folder}/mark/v={n + 1}/_SUCCESS"):
            n += 1
        return n

    def table(self, name: str) -> DataFrame:
        n = self.version()
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}/v={n}") if n else self.spark.createDataFrame([], TABLES[name])

    def _write(self, **tables: DataFrame) -> None:
        n = self.version() + 1
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/v={n}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.folder}/mark/v={n}")

    def add(self, rows: DataFrame, threshold: float = 0.85, dedup: str = "intended") -> DataFrame:
        """``doc_id, entity_id, person_db_id, is_new, merge_confidence, resolved_at`` of entities (``doc_id, page_num, entry_index, entity``) taken
        in the order of documents, pages and entries; the store gets new persons, later times of known ones, events and documents.

        Sorted rows get rising, not gapless, numbers, so new ids have gaps. With ``dedup="intended"`` an event that a person has
        already is not added. Without entities nothing is written.
        """
        seq = cut(rows.orderBy("doc_id", "page_num", "entry_index").withColumn("seq", F.monotonically_increasing_id()))
        if seq.isEmpty():
            return self.spark.createDataFrame([], RESULT)
        people = seq.select("seq", X.plain_surname(F.col("entity.surname")).alias("surname"))
        persons, events, sources = self.table("persons"), self.table("events"), self.table("sources")
        stored = persons.select("id", F.col("surname_normalized").alias("surname"))
        found = cut(R.resolve(people, threshold, stored).withColumnRenamed("surname", "plain"))
        named = seq.select("seq", F.col("entity.surname").alias("surname"), F.col("entity.given_names").alias("given_names"))
        every = R.insert_persons(persons, found.withColumnRenamed("plain", "surname"), named)
        now = F.current_timestamp()
        every = R.touch(every, found.where("NOT is_new").select(F.col("person").alias("id"), now.alias("at")))
        joined = cut(seq.join(found, "seq"))
        e = F.col("entity")
        facts = joined.select(F.col("person").alias("person_id"), *(e[c].alias(c) for c in ("birth_date", "death_date", "locations", "roles")), "seq")
        made = R.entity_events(facts, dedup="literal", keep=("seq",)).join(joined.select("seq", "doc_id", e.alias("entity")), "seq")
        key = ["person_id", "event_type", "event_date", "location", "detail"]
        new = made.select(
            *key, F.col("entity.confidence").alias("confidence"), F.col("entity.extraction_method").alias("extraction_method"), F.col("doc_id").alias("source_doc_id"),
            F.col("entity.slice_id").alias("source_slice_id"), F.col("entity.raw_text").alias("raw_text"), now.alias("created_at"),
        )
        if dedup == "intended":
            same = F.md5(F.concat_ws("\x00", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in key]))
            new = new.withColumn("_k", same).dropDuplicates(["_k"]).join(events.select(same.alias("_k")).distinct(), "_k", "left_anti").drop("_k")
        first = (events.agg(F.max("id")).first()[0] or 0) + 1
        new = new.withColumn("id", F.monotonically_increasing_id() + first)
        docs = R.new_sources(sources, joined.select("doc_id"))
        null, first = F.lit(None).cast("string"), (sources.agg(F.max("id")).first()[0] or 0) + 1
        docs = docs.select((F.monotonically_increasing_id() + first).alias("id"), "doc_id", null.alias("filename"), null.alias("source_url"), null.alias("warc_id"), now.alias("processed_at"))
        self._write(persons=cut(every), events=events.unionByName(cut(new.select(*events.columns))), sources=sources.unionByName(docs))
        return joined.select("doc_id", e["entity_id"].alias("entity_id"), F.col("person").alias("person_db_id"), "is_new", "merge_confidence", now.alias("resolved_at"))
