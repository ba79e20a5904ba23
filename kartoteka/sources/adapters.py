"""What the environment lends to the pipeline: functions over the bytes of one document, image or prompt, called by the executors."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.config import Extraction, Settings
from kartoteka.errors import AcquisitionError, ExtractionError, OCRError
from kartoteka.sources.files import local_documents
from kartoteka.sources.web import Fetch, captures, fetch_captures

#: ``render(content) -> pages`` of ``(text, drawings, grey image as PNG)``; ``read(image) -> words`` of ``(word, confidence from 0 to
#: 100, left, top, width, height)``.
Render = Callable[[bytes], Iterable[tuple[str, int, bytes]]]
Read = Callable[[bytes], Iterable[tuple[str, float, int, int, int, int]]]

#: Images of so many bytes are handed on together.
BATCH_BYTES = 16_000_000

_PAGES = "doc_id string, page_num int, n_pages int, text string, drawings int, image_bytes binary, error string"
_WORDS = "doc_id string, slice_id string, position int, word string, conf int, left int, top int, width int, height int, error string"


def render_pages(documents: DataFrame, render: Render) -> DataFrame:
    """``doc_id, page_num, n_pages, text, drawings, image_bytes, error`` of documents (``doc_id, content``): one row per page. A document
    without content or pages has one row without a page; one that cannot be read has one row with the error."""

    names = ["doc_id", "page_num", "n_pages", "text", "drawings", "image_bytes", "error"]
    numbers = {"page_num": "Int64", "n_pages": "Int64", "drawings": "Int64"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, size = [], 0
            for doc_id, content in zip(batch["doc_id"], batch["content"]):
                try:
                    pages = list(render(bytes(content))) if content else []
                    out += [(doc_id, i, len(pages), t, n, b, None) for i, (t, n, b) in enumerate(pages)] or [(doc_id, None, 0, None, None, None, None)]
                    size += sum(len(b or b"") for _, _, b in pages)
                except Exception as e:  # noqa: BLE001 - one bad document must not end the job
                    out.append((doc_id, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                if size >= BATCH_BYTES:
                    yield pd.DataFrame(out, columns=names).astype(numbers)
                    out, size = [], 0
            yield pd.DataFrame(out, columns=names).astype(numbers)

    return documents.select(F.col("doc_id").cast("string"), "content").mapInPandas(run, _PAGES)


def read_words(slices: DataFrame, read: Read) -> DataFrame:
    """``doc_id, slice_id, position, word, conf, left, top, width, height, error`` of slices (``doc_id, slice_id, image_bytes, error``): one
    row per word. A slice without words has one row without a word; a failed one, or one with an error before, its error."""
    names = ["doc_id", "slice_id", "position", "word", "conf", "left", "top", "width", "height", "error"]
    numbers = {c: "Int64" for c in ("position", "conf", "left", "top", "width", "height")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, slice_id, image, error in zip(batch["doc_id"], batch["slice_id"], batch["image_bytes"], batch["error"]):
                words = []
                if not error:
                    try:
                        words = [(w, int(c), *box) for w, c, *box in read(bytes(image))]
                    except Exception as e:  # noqa: BLE001 - one bad image must not end the job
                        error = f"{type(e).__name__}: {e}"
                out += [(doc_id, slice_id, i, *w, None) for i, w in enumerate(words)] or [(doc_id, slice_id, *[None] * 7, error)]
            yield pd.DataFrame(out, columns=names).astype(numbers)

    return slices.select("doc_id", "slice_id", "image_bytes", "error").mapInPandas(run, _WORDS)


def recogniser_ready(version: Callable[[], str], languages: Callable[[], Sequence[str]], wanted: str = "pol+pol_frak") -> str:
    """The recogniser's version. A recogniser that does not answer is an :class:`OCRError`; a missing language is a warning."""
    try:
        found = version()
    except Exception as e:
        raise OCRError("phase4_ocr", "unknown", f"no recogniser: {e}") from e
    missing = [x for x in wanted.split("+") if x not in set(languages())]
    if missing:
        warnings.warn(f"the recogniser lacks {', '.join(missing)}", stacklevel=2)
    return found


@dataclass(frozen=True)
class HttpFetch:
    """``fetch(url, headers) -> (status, body)`` over HTTP."""

    timeout_s: float = 30.0

    def __call__(self, url: str, headers: dict[str, str]) -> tuple[int, bytes]:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=self.timeout_s) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()


@dataclass(frozen=True)
class ModelClient:
    """A language model that answers JSON posted to ``/api/generate``; whatever goes wrong is an :class:`ExtractionError`."""

    settings: Extraction = Extraction()

    def __call__(self, prompt: str) -> str:
        body = json.dumps({"model": self.settings.model, "prompt": prompt, "stream": False, "format": "json"}).encode()
        request = urllib.request.Request(self.settings.model_url.rstrip("/") + "/api/generate", body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.settings.timeout_s) as answer:
                return json.loads(answer.read())["response"]
        except (OSError, ValueError, KeyError, TypeError) as e:
            raise ExtractionError("phase5_extraction", "unknown", f"{type(e).__name__}: {e}") from e


def inputs(spark: SparkSession, settings: Settings, fetch: Fetch | None = None, index: str = "", data: str = "") -> DataFrame:
    """``doc_id, content, source, source_url, warc_id, filename, error`` of the documents that the settings name: the files of a folder
    (none if it is missing), or captures of a web archive, whose failures have an error. Another source is a ValueError."""
    null = F.lit(None).cast("string")
    if settings.source == "local":
        files = local_documents(spark, settings.input_dir, missing="empty")
        return files.select("doc_id", "content", F.lit("local").alias("source"), null.alias("source_url"), null.alias("warc_id"), "filename", null.alias("error"))
    if settings.source != "commoncrawl":
        raise ValueError(f"no source named {settings.source}")
    fetch, cc = fetch or HttpFetch(settings.commoncrawl.timeout_s), settings.commoncrawl
    got = fetch_captures(captures(spark, index, list(cc.domains), fetch, cc.max_records, cc.page_size), data, fetch)
    name = F.coalesce(F.substring(F.sha2(F.coalesce("content", F.col("url").cast("binary")), 256), 1, 16), F.lit("unknown"))
    return got.select(name.alias("doc_id"), "content", F.lit("commoncrawl").alias("source"), F.col("url").alias("source_url"), "warc_id", F.element_at(F.split("url", "/"), -1).alias("filename"), "error")


def local_file(spark: SparkSession, path: str) -> bytes:
    """The bytes of one file of any Hadoop file system. A missing path, a folder and a file that cannot be read are told apart."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        raise AcquisitionError("phase1_acquisition", "unknown", f"{path} does not exist")
    if system.getFileStatus(where).isDirectory():
        raise AcquisitionError("phase1_acquisition", "unknown", f"{path} is not a file")
    try:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    except Exception as e:
        raise AcquisitionError("phase1_acquisition", "unknown", f"cannot read {path}: {e}") from e
