"""Step registry: built-in types plus custom providers (``type -> factory(spec) -> Step``)."""

from __future__ import annotations

from collections.abc import Callable

from ..errors import TransformError
from .base import Step
from .builtin import BUILTIN_STEPS
from .spec import StepSpec

Factory = Callable[[StepSpec], Step]


class StepRegistry:
    """Step types by name: the built-ins plus custom factories (``spec -> Step``)."""

    def __init__(self, providers: dict[str, Factory] | None = None):
        self._factories: dict[str, Factory] = {kind: step.from_spec for kind, step in BUILTIN_STEPS.items()}
        for kind, factory in (providers or {}).items():
            self.register(kind, factory)

    def register(self, kind: str, factory: Factory) -> None:
        """Add a custom step type; a type that already exists is an error."""
        if kind in self._factories:
            raise TransformError(f'A transform of type "{kind}" is registered already.')
        self._factories[kind] = factory

    @property
    def types(self) -> list[str]:
        return sorted(self._factories)

    def create(self, spec: StepSpec) -> Step:
        factory = self._factories.get(spec.type)
        if factory is None:
            raise TransformError(
                f'No transform has the type "{spec.type}"; there are {", ".join(self.types)}.')
        return factory(spec)

    def build(self, config) -> "Pipeline":  # noqa: F821 - import below to avoid a cycle
        """A :class:`~tapline.plans.pipeline.Pipeline` from a :class:`TransformConfig`."""
        from ..plans.pipeline import Pipeline, PipelineStep

        steps = []
        names: set[str | None] = set()
        for spec in config.specs:
            if spec.label is not None and spec.label in names:
                raise TransformError(f'Two transforms are named "{spec.label}".')
            names.add(spec.label)
            steps.append(PipelineStep(spec.name, self.create(spec)))
        return Pipeline(steps, config.error_strategy, config.contract)


def default_registry() -> StepRegistry:
    """A registry with the built-in step types only."""
    return StepRegistry()
