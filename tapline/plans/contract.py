"""Output contract: which fields the final schema must and may hold, checked before any row is read."""

from __future__ import annotations

from dataclasses import dataclass

from ..errors import TransformError


@dataclass(frozen=True)
class OutputContract:
    """Required and optional fields; ``closed`` allows no others."""

    required: frozenset[str] = frozenset()
    optional: frozenset[str] = frozenset()
    closed: bool = False

    @classmethod
    def from_config(cls, node) -> "OutputContract | None":
        """The ``validateOutput`` object of a configuration; none if it is absent or not enabled."""
        if not isinstance(node, dict) or not _on(node, "enabled", True):
            return None
        return cls(_fields(node, "requiredFields"), _fields(node, "optionalFields"), _on(node, "failOnUnknownFields", False))

    def validate(self, names: list[str]) -> None:
        """One error that tells of every breach."""
        present = set(names)
        missing = sorted(self.required - present)
        strange = sorted(present - self.required - self.optional) if self.closed else []
        told = [f"{what} {', '.join(fields)}" for what, fields in (("it lacks", missing), ("it must not hold", strange)) if fields]
        if told:
            raise TransformError(f"The output breaks its contract: {'; '.join(told)}.")


def _fields(node: dict, key: str) -> frozenset[str]:
    listed = node.get(key)
    return frozenset(str(x).lower() if isinstance(x, bool) else str(x) for x in listed) if isinstance(listed, list) else frozenset()


def _on(node: dict, key: str, default: bool) -> bool:
    """A switch: a boolean, a number other than 0, or the text ``true``."""
    value = node.get(key)
    if value is None:
        return default
    return value.strip().lower() == "true" if isinstance(value, str) else isinstance(value, (bool, int, float)) and bool(value)
