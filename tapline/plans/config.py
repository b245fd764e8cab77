"""Declarative pipeline configuration: a JSON document and/or inline shorthand specs.

JSON: either an array of ``{"type": ..., ...}`` objects, or an object with ``transforms`` plus
optional ``errorStrategy`` and ``validateOutput``. Inline shorthand (one spec per string):
``rename:a=b``, ``drop:a,b``, ``keep:a,b``, ``addStatic:k=v,...``, ``default:c=v``,
``mask:c`` / ``mask:c=token``, ``map:c=A>X,B>Y``, ``template:name=...``, ``expression:name=...``.
File specs come first, then inline specs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from ..errors import TransformError
from ..operators.builtin import BUILTIN_STEPS
from ..operators.spec import StepSpec
from .contract import OutputContract
from .pipeline import error_strategy_from_config


@dataclass
class TransformConfig:
    """Ordered step specs, the error strategy and the optional output contract."""

    specs: list[StepSpec] = field(default_factory=list)
    error_strategy: str = "fail"
    contract: OutputContract | None = None


def load_config(document=None, inline: list[str] | tuple[str, ...] = (),
                error_strategy: str | None = None, source: str = "transforms") -> TransformConfig:
    """Build a config from a JSON document (text, list or dict) plus inline specs.

    ``error_strategy``, when given, overrides the document's ``errorStrategy``.
    """
    root = json.loads(document) if isinstance(document, str) else document
    settings = root if isinstance(root, dict) else {"transforms": [] if root is None else root}
    nodes = settings.get("transforms")
    if not isinstance(nodes, list):
        raise TransformError(f"{source}: expected an array of transforms, or an object that has one under \"transforms\".")
    if not all(isinstance(n, dict) and n.get("type") is not None for n in nodes):
        raise TransformError(f'{source}: every transform is an object with a "type".')
    specs = [StepSpec(str(n["type"]), {k: v for k, v in n.items() if k != "type"}) for n in nodes]
    specs += [parse_inline(raw) for raw in inline or ()]
    strategy = error_strategy if error_strategy is not None else settings.get("errorStrategy")
    return TransformConfig(specs, "fail" if strategy is None else error_strategy_from_config(strategy),
                           OutputContract.from_config(settings.get("validateOutput")))


def load_config_file(path: str, inline=(), error_strategy: str | None = None) -> TransformConfig:
    """A config from a JSON file, then inline specs; ``error_strategy`` overrides the file's."""
    try:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
    except OSError as exc:
        raise TransformError(f"Failed to read transforms file {path}: {exc}") from None
    try:
        document = json.loads(text)
    except json.JSONDecodeError as exc:
        raise TransformError(f"Failed to read transforms file {path}: {exc}") from None
    return load_config(document, inline, error_strategy, source=f"file {path}")


def parse_inline(raw: str) -> StepSpec:
    """One inline spec, such as ``rename:a=b`` or ``map:c=A>X,B>Y``: the step's own shorthand tells its parts apart."""
    kind, _, rest = raw.partition(":")
    step = BUILTIN_STEPS.get(kind.strip())
    if step is None:
        raise TransformError(f'No transform has a shorthand like "{raw}"; write <type>:<options> with a type of '
                             f'{", ".join(BUILTIN_STEPS)}, or use a transforms document.')
    found = step.shorthand.fullmatch(rest)
    if found is None:
        raise TransformError(f'Cannot read "{raw}"; write {kind.strip()}:{step.usage}.')
    return StepSpec(kind.strip(), {k.rstrip("_"): v for k, v in found.groupdict().items() if v is not None})


def build_pipeline(document=None, inline=(), error_strategy: str | None = None, registry=None):
    """Config straight to a :class:`~tapline.plans.pipeline.Pipeline`."""
    from ..operators.registry import default_registry

    config = load_config(document, inline, error_strategy)
    return (registry or default_registry()).build(config)
