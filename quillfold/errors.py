"""Errors of the pipeline; all can be caught as ``PipelineError``."""

from __future__ import annotations


class PipelineError(Exception):
    """Any failure of a document's run; ``stage`` is the last stage that ended, if one did."""

    def __init__(self, message: str = "", stage: str | None = None):
        super().__init__(message)
        self.stage = stage


class ExtractionError(PipelineError):
    """Text, tables or metadata can't be taken from a document."""


class WeakEvidenceError(ExtractionError):
    """The document doesn't say what is asked for."""


class TaxonomyMappingError(ExtractionError):
    """An asset has no place in the taxonomy."""


class ValidationError(PipelineError):
    """A record breaks its schema or a rule."""


class LLMError(PipelineError):
    """A model's call failed, or its answer can't be read."""


class StorageError(PipelineError):
    """A table or blob can't be read or written."""


#: The errors by name, for outcomes that are rows.
ERRORS = {e.__name__: e for e in (PipelineError, ExtractionError, WeakEvidenceError, TaxonomyMappingError, ValidationError, LLMError, StorageError)}
