"""Captured documents from web archives: index pages and archive records. The network is an injected function."""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.errors import AcquisitionError
from kartoteka.functions.json import cdx_record

#: ``fetch(url, headers) -> (status, body)``
Fetch = Callable[[str, dict[str, str]], tuple[int, bytes]]


def index_urls(base: str, domain: str, page_size: int = 500) -> Iterator[str]:
    """The index queries of a domain's PDF captures, page after page."""
    page = 0
    while True:
        yield base + "?" + urlencode({"url": f"{domain}/*", "output": "json", "filter": "mime:application/pdf", "fl": "url,offset,length,filename", "pageSize": page_size, "page": page})
        page += 1


def captures(spark: SparkSession, base: str, domains: list[str], fetch: Fetch, limit: int, page_size: int = 500) -> DataFrame:
    """``url, offset, length, warc_filename`` of up to ``limit`` captures in the order of domains and pages. A domain ends at status
    404 or an empty page; another status raises; malformed lines are left out and do not count."""
    kind = "n bigint, line string"
    lines: list[tuple[int, str]] = []
    seen = valid = 0  # lines that have been parsed, and captures among them

    def parsed(part: list[tuple[int, str]]) -> DataFrame:
        return spark.createDataFrame(part, kind).withColumn("r", cdx_record(F.col("line"))).where("r IS NOT NULL")

    for domain in domains:
        for url in index_urls(base, domain, page_size):
            status, body = fetch(url, {})
            if status == 404 or (status == 200 and not body.strip()):
                break
            if status != 200:
                raise AcquisitionError("phase1_acquisition", "unknown", f"index answered {status} for {domain}")
            lines += [(len(lines) + i, s) for i, s in enumerate(body.decode().splitlines()) if s.strip()]
            if valid + len(lines) - seen >= limit:
                valid, seen = valid + parsed(lines[seen:]).count(), len(lines)
                if valid >= limit:
                    break
        if valid >= limit:
            break
    return parsed(lines).orderBy("n").limit(limit).select("r.*")


def pdf_of_record(data: bytes) -> tuple[bytes, str | None]:
    """Body and record id of the first response with a PDF content type in archive bytes, gzipped or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        head, sep, rest = data[at:].partition(b"\r\n\r\n")
        if not sep:
            break
        fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:]))
        size = int(fields.get("content-length", 0))
        block = rest[:size]
        if fields.get("warc-type") == "response":
            http, sep, body = block.partition(b"\r\n\r\n")
            kinds = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-type")]
            if sep and any(b"pdf" in k.lower() for k in kinds):
                return body, fields.get("warc-record-id")
        at += len(head) + 4 + size
    raise ValueError("no PDF response in the record")


def fetch_captures(records: DataFrame, base: str, fetch: Fetch) -> DataFrame:
    """``url, warc_id, content, error`` of captures: the byte range of each is fetched by the executors; statuses other than 200 and 206,
    and records without a PDF, give an error."""

    def one(name: str, offset: int, length: int) -> tuple[bytes | None, str | None, str | None]:
        try:
            status, body = fetch(base + name, {"Range": f"bytes={offset}-{offset + length - 1}"})
            if status not in (200, 206):
                return None, None, f"status {status}"
            content, record = pdf_of_record(body)
            return content, record, None
        except Exception as e:  # noqa: BLE001 - one bad record must not end the job
            return None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [one(n, int(o), int(size)) for n, o, size in zip(batch["warc_filename"], batch["offset"], batch["length"])]
            yield pd.DataFrame({"url": batch["url"], "warc_id": [g[1] for g in got], "content": [g[0] for g in got], "error": [g[2] for g in got]})

    return records.select("url", "warc_filename", "offset", "length").mapInPandas(run, "url string, warc_id string, content binary, error string")
