"""Pipeline steps: the step model, the built-in steps, specs and the step registry."""

from .base import COLUMN_CHANGING, Capabilities, Field, RowView, SqlExpression, Step, StepOutput
from .builtin import (
    AddStaticStep,
    DefaultStep,
    DropStep,
    ExpressionStep,
    KeepStep,
    MapStep,
    MapTableStep,
    MaskStep,
    RenameStep,
    TemplateStep,
    parse_literal,
    template_parts,
)
from .custom import ColumnStep, PandasStep
from .registry import StepRegistry, default_registry
from .spec import StepSpec

__all__ = [
    "COLUMN_CHANGING", "Capabilities", "Field", "RowView", "SqlExpression", "Step", "StepOutput",
    "AddStaticStep", "DefaultStep", "DropStep", "ExpressionStep", "KeepStep", "MapStep", "MapTableStep", "MaskStep",
    "RenameStep", "TemplateStep", "parse_literal", "template_parts", "ColumnStep", "PandasStep",
    "StepRegistry", "default_registry", "StepSpec",
]
