"""The step model.

A step never sees a row. It sees the *current columns* (names, canonical types and column
expressions) and returns new column expressions plus, optionally, a per-row failure condition
and a per-row keep condition. The pipeline folds the steps into projections over one DataFrame,
so every built-in step runs inside Spark's generated code; Catalyst collapses the projections.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformError


@dataclass(frozen=True)
class Capabilities:
    """What a step does to the table: change the column set, work per row, be deterministic."""

    schema_changing: bool = False
    row_level: bool = True
    deterministic: bool = True


COLUMN_CHANGING = Capabilities(schema_changing=True)


@dataclass(frozen=True)
class SqlExpression:
    """A Spark SQL expression over the current column names, resolved by the pipeline."""

    text: str


@dataclass
class StepOutput:
    """What a step returns.

    ``columns``: the ordered output columns, name -> Column (or :class:`SqlExpression`).
    ``fail``:   the row fails at this step where true (error strategy applies).
    ``keep``:   the row goes on where true; false or null drops it as filtered.
    ``sensitive``: output columns whose values are redacted (reported in metadata).
    ``messages``: value-free text reported when a row fails at this step.
    ``lookups``: tables the columns are looked up in (:class:`~tapline.operators.lookup.TableLookup`).
    """

    columns: list[tuple[str, Column | SqlExpression]]
    fail: Column | None = None
    keep: Column | None = None
    sensitive: tuple[str, ...] = ()
    message: str | None = None
    lookups: tuple = ()


@dataclass
class Field:
    """One current column: logical name, the internal column carrying it, type and metadata."""

    name: str
    internal: str
    dtype: T.DataType
    metadata: dict = field(default_factory=dict)


class RowView:
    """The current columns as a step sees them. Name lookup is exact and case-sensitive."""

    def __init__(self, fields: list[Field], column_of, live: Column | None = None):
        self._fields = list(fields)
        self.live = live if live is not None else F.lit(True)  # false once the row failed or was dropped
        self._by_name = {f.name: f for f in fields}
        self._column_of = column_of
        self._cache: dict[str, Column] = {}

    @property
    def names(self) -> list[str]:
        return [f.name for f in self._fields]

    @property
    def fields(self) -> list[Field]:
        return list(self._fields)

    def has(self, name: str) -> bool:
        return name in self._by_name

    def require(self, name: str, step_type: str) -> Field:
        found = self._by_name.get(name)
        if found is None:
            raise TransformError(f'Transform "{step_type}" references unknown column "{name}".')
        return found

    def dtype(self, name: str) -> T.DataType:
        return self._by_name[name].dtype

    def __getitem__(self, name: str) -> Column:
        if name not in self._cache:
            self._cache[name] = self._column_of(self._by_name[name])
        return self._cache[name]

    def passthrough(self) -> list[tuple[str, Column]]:
        """All current columns unchanged, in order."""
        return [(f.name, self[f.name]) for f in self._fields]


class Step:
    """A pipeline step. Subclasses set ``type_name`` and implement :meth:`build`.

    ``build`` is called once, at plan time, before any row is read; it validates column
    references (raising :class:`TransformError`) and returns column expressions.
    """

    type_name: str = "step"
    capabilities: Capabilities = Capabilities()

    def build(self, row: RowView) -> StepOutput:  # pragma: no cover - interface
        raise NotImplementedError

    def declared_columns(self, input_names: list[str]) -> list[str] | None:
        """For custom steps: the exact output names they promise (checked against ``build``)."""
        return None

    def sensitive_columns(self) -> tuple[str, ...]:
        return ()
