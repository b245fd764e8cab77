"""Column-name rules. These touch only schema metadata, never rows."""

from __future__ import annotations

import re

from ..errors import SchemaError, TransformError


def normalize_output_name(label: str) -> str:
    """Output name of a query column: trimmed and lower-cased (locale-free)."""
    return label.strip().lower()


def normalized_names(labels: list[str]) -> list[str]:
    """Normalise every label; two labels that normalise to one name are an error."""
    names: list[str] = []
    seen: dict[str, str] = {}
    for label in labels:
        name = normalize_output_name(label)
        if name in seen:
            raise SchemaError(
                f'Query returns duplicate column name "{name}" (from "{seen[name]}" and "{label}"); '
                "give each column a distinct alias.")
        seen[name] = label
        names.append(name)
    return names


_NOT_NAME_CHAR = re.compile(r"[^A-Za-z0-9_]")


def sanitize_field_name(name: str | None) -> str:
    """A name valid as ``[A-Za-z_][A-Za-z0-9_]*``.

    Any other character becomes ``_``; a name that then starts with a digit gets a leading
    ``_``; a blank name becomes ``_column``.
    """
    if name is None or not name.strip():
        return "_column"
    clean = _NOT_NAME_CHAR.sub("_", name)
    return "_" + clean if clean[0] in "0123456789" else clean


def sanitized_names(names: list[str]) -> list[str]:
    """Sanitise all names; a collision after sanitising is an error."""
    result: list[str] = []
    seen: dict[str, str] = {}
    for name in names:
        clean = sanitize_field_name(name)
        if clean in seen:
            raise TransformError(
                f'Columns "{seen[clean]}" and "{name}" both become field "{clean}" in Parquet; rename one.')
        seen[clean] = name
        result.append(clean)
    return result


def spare_names(df, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
