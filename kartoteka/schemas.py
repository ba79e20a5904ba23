"""Row types of the phases and stores."""

from __future__ import annotations


def column_names(ddl: str) -> list[str]:
    """Names of the columns of a schema text."""
    depth, names, word = 0, [], ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            names.append(word.split()[0])
            word = ""
        else:
            word += c
    return names


BOX = "struct<x1:int,y1:int,x2:int,y2:int>"
INPUT = "source string, local_path string, warc struct<url:string,offset:bigint,length:bigint,warc_filename:string>"
ACQUIRED = "doc_id string, content binary, source string, source_url string, warc_id string, lang_score double, filename string, acquired_at timestamp"
CLASSIFIED = "doc_id string, doc_type string, confidence double, sample_page_indices array<int>, classified_at timestamp"
SLICE = f"struct<slice_id:string,page_num:int,entry_index:int,bbox:{BOX},image_bytes:binary>"
LAYOUT = f"doc_id string, doc_type string, slices array<{SLICE}>, analyzed_at timestamp"
OCR_ENTRY = f"struct<slice_id:string,text:string,confidence_score:double,bboxes:array<{BOX}>,needs_review:boolean>"
OCR = f"doc_id string, ocr_entries array<{OCR_ENTRY}>, processed_at timestamp"
ENTITY = (
    "struct<entity_id:string,slice_id:string,surname:string,given_names:array<string>,birth_date:string,death_date:string,"
    "locations:array<string>,roles:array<string>,raw_text:string,confidence:double,extraction_method:string>"
)
EXTRACTED = f"doc_id string, entities array<{ENTITY}>, extracted_at timestamp"
FIELDS = "struct<surname:string,given_names:array<string>,birth_date:string,death_date:string,locations:array<string>,roles:array<string>>"
RESOLVED = "doc_id string, resolved_persons array<struct<person_db_id:bigint,entity_id:string,is_new:boolean,merge_confidence:double>>, resolved_at timestamp"
PERSONS = "id bigint, surname string, given_names array<string>, surname_normalized string, created_at timestamp, updated_at timestamp"
EVENTS = (
    "id bigint, person_id bigint, event_type string, event_date string, location string, detail string, confidence double,"
    "extraction_method string, source_doc_id string, source_slice_id string, raw_text string, created_at timestamp"
)
SOURCES = "id bigint, doc_id string, filename string, source_url string, warc_id string, processed_at timestamp"
REVIEW = (
    "id bigint, doc_id string, slice_id string, phase_name string, reason string, data_snapshot string, created_at timestamp,"
    "status string, resolved_at timestamp, resolution_notes string, corrected_data string"
)
PATTERNS = "fingerprint string, regex string, created_at timestamp, hit_count int, last_used timestamp"
FAILURE = "timestamp timestamp, phase string, doc_id string, error_class string, message string, traceback string, input_data string"
CDX = "url string, offset string, length string, filename string"

SOURCES_OF_DOCUMENTS = ("local", "commoncrawl")
DOC_TYPES = ("directory", "newspaper", "civil_record", "unknown")
METHODS = ("regex_cached", "llm_ollama", "llm_api", "manual")
STATUSES = ("pending", "accepted", "corrected", "discarded")
PHASES = ("phase1_acquisition", "phase2_classification", "phase3_layout", "phase4_ocr", "phase5_extraction", "phase6_resolution")
