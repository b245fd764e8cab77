"""Column functions: canonical values, ISO text, redaction, formula guard and name rules."""

from .names import normalize_output_name, normalized_names, sanitize_field_name, sanitized_names
from .values import (
    base64_text,
    canonical,
    formula_guard,
    iso_date,
    iso_time,
    iso_timestamp_ntz,
    iso_timestamp_utc,
    kind_of,
    non_finite_to_null,
    redact_credentials,
    redact_text,
    stringify,
)

__all__ = [
    "base64_text", "canonical", "formula_guard", "iso_date", "iso_time", "iso_timestamp_ntz",
    "iso_timestamp_utc", "kind_of", "non_finite_to_null", "redact_credentials", "redact_text",
    "stringify", "normalize_output_name", "normalized_names", "sanitize_field_name", "sanitized_names",
]
