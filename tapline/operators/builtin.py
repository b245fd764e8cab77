"""The built-in steps: rename, drop, keep, addStatic, default, map, mask, template, expression.

Each is a handful of native column expressions; none runs Python per row.
"""

from __future__ import annotations

import re
from decimal import Decimal, InvalidOperation, localcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformError
from ..functions.values import kind_of, stringify
from .base import COLUMN_CHANGING, RowView, SqlExpression, Step, StepOutput
from .lookup import TableLookup, literal_lookup
from .spec import StepSpec, choice, entries, names, text


class RenameStep(Step):
    """``from`` -> ``to``, keeping the position; the target must not exist unless equal."""

    type_name = "rename"
    capabilities = COLUMN_CHANGING

    def __init__(self, source: str, target: str):
        self.source, self.target = source, target

    shorthand, usage = re.compile(r"\s*(?P<from_>[^=]*?)\s*=(?P<to>.*)", re.S), "<column>=<new name>"

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "RenameStep":
        found = spec.values(from_=text(), to=text())
        return cls(found["from"], found["to"])

    def build(self, row: RowView) -> StepOutput:
        row.require(self.source, "rename")
        if self.source != self.target and row.has(self.target):
            raise TransformError(f'Transform "rename" cannot add column "{self.target}": there is one of that name.')
        cols = [((self.target if n == self.source else n), c) for n, c in row.passthrough()]
        return StepOutput(cols)


class DropStep(Step):
    """Remove the listed columns; each must exist."""

    type_name = "drop"
    capabilities = COLUMN_CHANGING

    def __init__(self, columns: list[str]):
        self.columns = list(columns)

    shorthand, usage = re.compile(r"(?P<columns>.*)", re.S), "<column>,..."

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "DropStep":
        return cls(**spec.values(columns=names()))

    def build(self, row: RowView) -> StepOutput:
        for name in self.columns:
            row.require(name, "drop")
        gone = set(self.columns)
        return StepOutput([(n, c) for n, c in row.passthrough() if n not in gone])


class KeepStep(Step):
    """Keep only the listed columns, in the listed order; a name may appear once."""

    type_name = "keep"
    capabilities = COLUMN_CHANGING

    def __init__(self, columns: list[str]):
        self.columns = list(columns)

    shorthand, usage = re.compile(r"(?P<columns>.*)", re.S), "<column>,..."

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "KeepStep":
        return cls(**spec.values(columns=names()))

    def build(self, row: RowView) -> StepOutput:
        seen: set[str] = set()
        out = []
        for name in self.columns:
            if name in seen:
                raise TransformError(f'Transform "keep" names column "{name}" more than once.')
            seen.add(name)
            row.require(name, "keep")
            out.append((name, row[name]))
        return StepOutput(out)


class AddStaticStep(Step):
    """Append constant string columns (a value may be null); names must be new."""

    type_name = "addStatic"
    capabilities = COLUMN_CHANGING

    def __init__(self, fields: dict[str, str | None]):
        self.fields = dict(fields)

    shorthand, usage = re.compile(r"(?P<fields>[^=]*=.*)", re.S), "<name>=<value>,..."

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "AddStaticStep":
        return cls(**spec.values(fields=entries("=", trim=False)))

    def build(self, row: RowView) -> StepOutput:
        for name in self.fields:
            if row.has(name):
                raise TransformError(f'Transform "addStatic" cannot add column "{name}": there is one of that name.')
        out = row.passthrough()
        out += [(name, F.lit(value).cast("string")) for name, value in self.fields.items()]
        return StepOutput(out)


_INT_TEXT = re.compile(r"[+-]?[0-9]+")
_DECIMAL_TEXT = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,4})?")
_FLOAT_TEXT = re.compile(r"[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?")
_INT_RANGE = {"INT": (-(2 ** 31), 2 ** 31 - 1), "LONG": (-(2 ** 63), 2 ** 63 - 1)}


def parse_literal(literal: str, dtype: T.DataType, step_type: str, column: str):
    """Parse a configured literal for a column's canonical kind, once, before any row is read."""
    kind = kind_of(dtype)

    def invalid() -> TransformError:
        return TransformError(
            f'Transform "{step_type}" cannot read "{literal}" as {kind}, the kind of column "{column}".')

    text = literal.strip()
    if kind == "BOOLEAN":
        if text.lower() in ("true", "false"):
            return text.lower() == "true"
        raise invalid()
    if kind in ("INT", "LONG"):
        if not _INT_TEXT.fullmatch(text):
            raise invalid()
        value = int(text)
        low, high = _INT_RANGE[kind]
        if not low <= value <= high:
            raise invalid()
        return value
    if kind in ("FLOAT", "DOUBLE"):
        if not _FLOAT_TEXT.fullmatch(text):
            raise invalid()
        return float(text.rstrip("fFdD"))
    if kind == "DECIMAL":
        if not _DECIMAL_TEXT.fullmatch(text):
            raise invalid()
        precision, scale = dtype.precision, dtype.scale  # type: ignore[attr-defined]
        unfit = TransformError(f'Transform "{step_type}" value "{literal}" does not fit column "{column}" '
                               f"({dtype.simpleString()}).")
        value = Decimal(text)
        with localcontext(prec=2 * 38 + 2):  # room for every decimal type
            try:
                exact = value.quantize(Decimal(1).scaleb(-scale))
            except InvalidOperation:
                raise unfit from None
            if value != exact or len(exact.as_tuple().digits) > precision and exact != 0:
                raise unfit
        return exact
    return literal


class DefaultStep(Step):
    """Fill nulls with a literal parsed for the column's type before any row is read."""

    type_name = "default"

    def __init__(self, column: str, value: str):
        self.column, self.value = column, value

    shorthand, usage = re.compile(r"\s*(?P<column>[^=]*?)\s*=(?P<value>.*)", re.S), "<column>=<value>"

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "DefaultStep":
        return cls(**spec.values(column=text(), value=text()))

    def build(self, row: RowView) -> StepOutput:
        target = row.require(self.column, "default")
        parsed = parse_literal(self.value, target.dtype, "default", self.column)
        fill = F.lit(parsed).cast(target.dtype)
        cols = [(n, F.coalesce(c, fill) if n == self.column else c) for n, c in row.passthrough()]
        return StepOutput(cols)


UNMATCHED_MODES = ("keep", "default", "fail")


class MapStep(Step):
    """Look up the value's text form; unmatched values are kept, defaulted or failed."""

    type_name = "map"

    def __init__(self, column: str, mapping: dict[str, str | None], unmatched: str = "keep",
                 default: str | None = None):
        if unmatched not in UNMATCHED_MODES:
            raise TransformError('Transform "map" "unmatched" must be one of keep, default, fail.')
        self.column, self.mapping, self.unmatched, self.default = column, dict(mapping), unmatched, default

    shorthand, usage = re.compile(r"\s*(?P<column>[^=]*?)\s*=(?P<mapping>.*)", re.S), "<column>=<key>><value>,..."

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "Step":
        if "table" in spec.config:
            return MapTableStep.from_spec(spec)
        fallback = text(required=spec.config.get("unmatched") == "default")
        found = spec.values(column=text(), mapping=entries(">", trim=True),
                            unmatched=choice(*UNMATCHED_MODES, default="keep"), default=fallback)
        return cls(**found)

    def build(self, row: RowView) -> StepOutput:
        target = row.require(self.column, "map")
        value = row[self.column]
        key = stringify(value, target.dtype)
        # Keys are matched on the value's text form; a key may map to null, so presence and
        # value are read separately.
        lookup = literal_lookup(self.mapping, key)
        matched = F.map_contains_key(lookup, key)
        if self.unmatched == "default":
            otherwise = F.lit(self.default).cast("string")
        elif self.unmatched == "fail":
            otherwise = F.lit(None).cast("string")
        else:
            otherwise = key
        mapped = (F.when(value.isNull(), F.lit(None).cast("string"))
                  .when(matched, F.try_element_at(lookup, key))
                  .otherwise(otherwise))
        cols = [(n, mapped if n == self.column else c) for n, c in row.passthrough()]
        fail = (value.isNotNull() & ~matched) if self.unmatched == "fail" else None
        return StepOutput(cols, fail=fail,
                          message=f'no mapping for a value in column "{self.column}"')


class MapTableStep(Step):
    """Look up the value's text form in a table's key column: a map step for mappings too large for a plan.

    ``table`` is a DataFrame or the name of a table or view. Keys and values are matched as text; null keys match
    nothing, a key may map to null, equal rows count once, and a key with two values is an error when the plan is
    built. See :mod:`tapline.operators.lookup` for how it is joined.
    """

    type_name = "map"

    def __init__(self, column: str, table, key: str, value: str, unmatched: str = "keep", default: str | None = None,
                 broadcast_bytes: int | None = None):
        if unmatched not in UNMATCHED_MODES:
            raise TransformError('Transform "map" "unmatched" must be one of keep, default, fail.')
        self.column, self.table, self.key, self.value = column, table, key, value
        self.unmatched, self.default, self.broadcast_bytes = unmatched, default, broadcast_bytes

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "MapTableStep":
        if "mapping" in spec.config:
            raise TransformError('Transform "map" takes either "mapping" or "table".')
        fallback = text(required=spec.config.get("unmatched") == "default")
        return cls(**spec.values(column=text(), table=text(), key=text(), value=text(),
                                 unmatched=choice(*UNMATCHED_MODES, default="keep"), default=fallback))

    def build(self, row: RowView) -> StepOutput:
        target = row.require(self.column, "map")
        value = row[self.column]
        key = stringify(value, target.dtype)
        lookup = TableLookup(key, self._frame(), self.key, self.value, self.broadcast_bytes)
        matched = F.coalesce(F.col(lookup.found), F.lit(False))
        otherwise = {"keep": key, "default": F.lit(self.default).cast("string"), "fail": F.lit(None).cast("string")}
        mapped = F.when(value.isNull(), F.lit(None).cast("string")).when(matched, F.col(lookup.value)).otherwise(
            otherwise[self.unmatched])
        return StepOutput([(n, mapped if n == self.column else c) for n, c in row.passthrough()],
                          fail=(value.isNotNull() & ~matched) if self.unmatched == "fail" else None,
                          message=f'no mapping for a value in column "{self.column}"', lookups=(lookup,))

    def _frame(self) -> DataFrame:
        if isinstance(self.table, DataFrame):
            return self.table
        try:
            return SparkSession.active().table(self.table)
        except AnalysisException:
            raise TransformError(f'Transform "map": there is no table "{self.table}".') from None


class MaskStep(Step):
    """Replace non-null values with a token; the columns are marked sensitive."""

    type_name = "mask"

    def __init__(self, columns: list[str], mask: str = "***"):
        self.columns, self.mask = list(columns), mask

    shorthand, usage = re.compile(r"\s*(?P<column>[^=]*?)\s*(=(?P<mask>.*))?", re.S), "<column> or <column>=<token>"

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "MaskStep":
        several = "columns" in spec.config
        found = spec.values(columns=names(required=several), column=text(required=not several),
                            mask=text(required=False, default="***"))
        return cls(found["columns"] if several else [found["column"]], found["mask"])

    def sensitive_columns(self) -> tuple[str, ...]:
        return tuple(self.columns)

    def build(self, row: RowView) -> StepOutput:
        for name in self.columns:
            row.require(name, "mask")
        token = F.lit(self.mask).cast("string")
        targets = set(self.columns)
        cols = [(n, F.when(c.isNotNull(), token) if n in targets else c) for n, c in row.passthrough()]
        return StepOutput(cols, sensitive=tuple(self.columns))


# Fixed value, equal to the reference's: a placeholder is "{" + one or more non-"}" chars + "}".
PLACEHOLDER = re.compile(r"\{([^}]+)\}")


def template_parts(template: str) -> list[tuple[str, bool]]:
    """Split a template into (text, is_placeholder) parts, in order."""
    parts: list[tuple[str, bool]] = []
    pos = 0
    for match in PLACEHOLDER.finditer(template):
        if match.start() > pos:
            parts.append((template[pos:match.start()], False))
        parts.append((match.group(1), True))
        pos = match.end()
    if pos < len(template):
        parts.append((template[pos:], False))
    return parts


class TemplateStep(Step):
    """Append a text column rendered from ``{column}`` placeholders (null renders empty)."""

    type_name = "template"
    capabilities = COLUMN_CHANGING

    def __init__(self, column: str, template: str):
        self.column, self.template = column, template
        self.parts = template_parts(template)

    shorthand, usage = re.compile(r"\s*(?P<name>[^=]*?)\s*=(?P<template>.*)", re.S), "<new column>=<template>"

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "TemplateStep":
        found = spec.values(name=text(), template=text())
        return cls(found["name"], found["template"])

    def build(self, row: RowView) -> StepOutput:
        if row.has(self.column):
            raise TransformError(f'Transform "template" cannot add column "{self.column}": there is one of that name.')
        pieces = []
        for text, is_ref in self.parts:
            if is_ref:
                field = row.require(text, "template")
                pieces.append(F.coalesce(stringify(row[text], field.dtype), F.lit("")))
            else:
                pieces.append(F.lit(text))
        rendered = F.concat(*pieces) if pieces else F.lit("")
        return StepOutput(row.passthrough() + [(self.column, rendered)])


class ExpressionStep(Step):
    """A computed string column from a Spark SQL expression over the current column names.

    The expression is Spark SQL, e.g. ``concat(lastName, ', ', firstName)`` or
    ``CASE WHEN activeFlag = 'Y' THEN 'ACTIVE' ELSE 'INACTIVE' END``. Syntax errors fail when the
    step is created; unknown columns, and calls into the JVM (looked for in the resolved expression), fail when
    the plan is built; all before any row is read. A run-time error is a failure of its row.
    """

    type_name = "expression"
    capabilities = COLUMN_CHANGING

    def __init__(self, output_field: str, expression: str):
        self.output_field, self.expression = output_field, expression
        _check_syntax(output_field, expression)

    shorthand, usage = re.compile(r"\s*(?P<outputField>[^=]*?)\s*=(?P<expression>.*)", re.S), "<new column>=<expression>"

    @classmethod
    def from_spec(cls, spec: StepSpec) -> "ExpressionStep":
        found = spec.values(outputField=text(), expression=text())
        return cls(found["outputField"], found["expression"])

    def build(self, row: RowView) -> StepOutput:
        if row.has(self.output_field):
            raise TransformError(
                f'Transform "expression" cannot add column "{self.output_field}": there is one of that name.')
        return StepOutput(row.passthrough() + [(self.output_field, SqlExpression(self.expression))],
                          message=f'expression "{self.output_field}" evaluation error')


def _check_syntax(output_field: str, expression: str) -> None:
    """Parse the expression text with Spark's parser (no job, no analysis)."""
    from pyspark.errors import AnalysisException, ParseException
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        # EXPLAIN parses the text and only describes the plan: unknown names are expected here
        # (columns are checked when the plan is built) and nothing is executed.
        spark.sql(f"EXPLAIN SELECT (\n{expression}\n)")
    except ParseException as exc:
        text = str(exc).strip().splitlines()[0]
        raise TransformError(
            f'Transform "expression" has an invalid expression for "{output_field}": {text}') from None
    except AnalysisException:
        pass


BUILTIN_STEPS = {cls.type_name: cls for cls in (RenameStep, DropStep, KeepStep, AddStaticStep, DefaultStep, MapStep,
                                               MaskStep, TemplateStep, ExpressionStep)}
