"""Failure classes, one per step of a run."""


class EtlError(Exception):
    """Any failure of a run."""


class ExtractionError(EtlError):
    """The source could not be read."""


class ApiResponseError(ExtractionError):
    """The source answered, but not with a JSON list."""


class TransformError(EtlError):
    """A layer could not be derived from the one before it."""


class LoadError(EtlError):
    """A layer could not be written."""


class GateError(EtlError):
    """A layer did not pass its quality gate, so nothing after it ran."""
