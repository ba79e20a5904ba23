"""Events of a run as rows: what happened to which document in which phase, one JSON line each."""

from __future__ import annotations

import json
import sys
import traceback as tb
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any, TextIO

from pyspark.sql import DataFrame, SparkSession

#: The fields of a line and where each comes from.
FIELDS: dict[str, Callable[[dict[str, Any]], Any]] = {
    "timestamp": lambda e: e["at"].isoformat(), "level": lambda e: e["level"].upper(), "phase_name": lambda e: e["phase"], "doc_id": lambda e: e["doc_id"], "message": lambda e: e["message"],
}
SCHEMA = ", ".join(f"{name} string" for name in (*FIELDS, "exc_info"))


@dataclass
class RunLog:
    """Collects the driver's events of one phase; each is printed as text and, with a ``folder``, added to ``pipeline.jsonl`` there."""

    phase: str
    folder: str | Path | None = None
    out: TextIO | None = None
    lines: list[dict[str, Any]] = field(default_factory=list)

    def note(self, message: str, level: str = "info", doc_id: str = "", error: BaseException | None = None) -> dict[str, Any]:
        event = {"at": datetime.now(UTC), "level": level, "phase": self.phase, "doc_id": doc_id, "message": message}
        line = {name: value(event) for name, value in FIELDS.items()}
        if error is not None:
            line["exc_info"] = "".join(tb.format_exception(error)).rstrip()
        self.lines.append(line)
        print(f"{line['timestamp']} {line['level']} {self.phase} {doc_id} {message}", file=self.out or sys.stderr)
        if self.folder is not None:
            Path(self.folder).mkdir(parents=True, exist_ok=True)
            with (Path(self.folder) / "pipeline.jsonl").open("a", encoding="utf-8") as lines:
                lines.write(json.dumps(line, ensure_ascii=False) + "\n")
        return line

    def table(self, spark: SparkSession) -> DataFrame:
        """The events so far as a table."""
        return spark.createDataFrame([(*(e[name] for name in FIELDS), e.get("exc_info")) for e in self.lines], SCHEMA)
