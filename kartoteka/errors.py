"""Errors of the driver side; in the data path an error is a column."""

from __future__ import annotations


class PipelineError(Exception):
    """Base of all errors here."""


class PhaseError(PipelineError):
    """A phase cannot go on with a document."""

    def __init__(self, phase: str, doc_id: str, message: str) -> None:
        super().__init__(f"[{phase}] doc={doc_id}: {message}")
        self.phase, self.doc_id, self.message = phase, doc_id, message


class AcquisitionError(PhaseError):
    pass


class OCRError(PhaseError):
    pass


class ExtractionError(PhaseError):
    pass


class ResolutionError(PhaseError):
    pass


class CheckpointError(PipelineError):
    pass


class ConfigError(PipelineError):
    pass
