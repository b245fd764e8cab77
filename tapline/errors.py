"""Error types raised while building or running an export.

Messages name steps and columns, never row values.
"""

from __future__ import annotations


class TaplineError(Exception):
    """Base class for all errors raised by this library."""


class TransformError(TaplineError):
    """Bad pipeline configuration, schema error, contract violation or a row failure under ``fail``."""


class SourceError(TaplineError):
    """The query or source table could not be resolved."""


class SchemaError(SourceError):
    """The query's columns cannot be exported, such as two of one name."""


class OutputError(TaplineError):
    """The output could not be written or published."""


class FormatError(OutputError):
    """An output format that is not known."""
