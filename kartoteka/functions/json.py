"""JSON in and out of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.text import clean_list
from kartoteka.schemas import CDX, FIELDS

# Fixed patterns: an object within a code fence, and the widest pair of braces.
FENCED, BRACED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```", r"(?s)\{.*\}"


def recover_object(raw: Column) -> Column:
    """The JSON object in a reply, as text: the whole reply, else a fenced block, else from the first to the last brace; null if
    none parses. A reply that is valid JSON but no object gives null."""
    whole = F.when(F.try_parse_json(raw).isNotNull(), raw)
    fenced = F.nullif(F.regexp_extract(raw, FENCED, 1), F.lit(""))
    braced = F.nullif(F.regexp_extract(raw, BRACED, 0), F.lit(""))
    text = F.coalesce(whole, F.when(F.try_parse_json(fenced).isNotNull(), fenced), F.when(F.try_parse_json(braced).isNotNull(), braced))
    return F.when(F.trim(text).startswith("{"), text)


def extracted_fields(raw: Column) -> Column:
    """The six fields of an extraction reply; lists that are missing or null are empty. Null if the reply holds no object."""
    data = F.from_json(recover_object(raw), FIELDS)
    return F.when(
        data.isNotNull(),
        F.struct(
            data["surname"].alias("surname"), clean_list(data["given_names"]).alias("given_names"), data["birth_date"].alias("birth_date"),
            data["death_date"].alias("death_date"), clean_list(data["locations"]).alias("locations"), clean_list(data["roles"]).alias("roles"),
        ),
    )


def pattern_reply(raw: Column) -> Column:
    """The pattern in a reply that wraps it in an object; null for a bare one."""
    return F.get_json_object(recover_object(raw), "$.regex")


def cdx_record(line: Column) -> Column:
    """One line of a capture index; text fields default to the empty string, numbers to 0, null for a malformed line."""
    data = F.from_json(F.when(F.try_parse_json(line).isNotNull(), line), CDX)
    return F.when(
        data.isNotNull(),
        F.struct(
            F.coalesce(data["url"], F.lit("")).alias("url"), F.coalesce(data["offset"].try_cast("bigint"), F.lit(0)).alias("offset"),
            F.coalesce(data["length"].try_cast("bigint"), F.lit(0)).alias("length"), F.coalesce(data["filename"], F.lit("")).alias("warc_filename"),
        ),
    )
