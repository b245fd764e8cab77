"""Custom steps.

* :class:`ColumnStep` - a step written as a function over the current columns that returns
  native column expressions (the fast path: stays in generated code).
* :class:`PandasStep` - a step written as a function over a pandas batch of rows, run as one
  Arrow-batched pandas UDF per step. For logic that Spark's functions cannot express.

Both declare their output columns, and the pipeline checks the declaration.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformError
from ..functions.values import stringify
from .base import Capabilities, RowView, Step, StepOutput
from .spec import StepSpec, text

KEEP_FLAG = "__keep__"
FAIL_FLAG = "__fail__"


class ColumnStep(Step):
    """``fn(row: RowView) -> StepOutput``; ``declare(input_names) -> output names`` (optional)."""

    def __init__(self, type_name: str, fn: Callable[[RowView], StepOutput],
                 declare: Callable[[list[str]], list[str]] | None = None,
                 capabilities: Capabilities = Capabilities(), sensitive: tuple[str, ...] = ()):
        self.type_name = type_name
        self.capabilities = capabilities
        self._fn, self._declare, self._sensitive = fn, declare, tuple(sensitive)

    def build(self, row: RowView) -> StepOutput:
        return self._fn(row)

    def declared_columns(self, input_names):
        return None if self._declare is None else list(self._declare(list(input_names)))

    def sensitive_columns(self):
        return self._sensitive


class PandasStep(Step):
    """A row-level step over pandas batches.

    ``fn(batch) -> batch`` gets the rows that are still live, with logical column names, and
    returns a frame with exactly ``output_schema``'s columns, row for row, plus optional boolean
    ``__keep__`` (false drops the row) and ``__fail__`` (true fails it) columns. Rows for which ``fn``
    raises fail; the other rows of their batch go on.
    """

    def __init__(self, type_name: str, fn: Callable[[pd.DataFrame], pd.DataFrame],
                 output_schema: T.StructType, inputs: list[str] | None = None,
                 deterministic: bool = True):
        self.type_name = type_name
        self.capabilities = Capabilities(schema_changing=True, row_level=True, deterministic=deterministic)
        self.fn, self.output_schema, self.inputs, self.deterministic = fn, output_schema, inputs, deterministic

    def declared_columns(self, input_names):
        return [f.name for f in self.output_schema.fields]

    def build(self, row: RowView) -> StepOutput:
        names = self.inputs if self.inputs is not None else row.names
        for name in names:
            row.require(name, self.type_name)
        out_names = [f.name for f in self.output_schema.fields]
        result_type = T.StructType(list(self.output_schema.fields) + [
            T.StructField(KEEP_FLAG, T.BooleanType()), T.StructField(FAIL_FLAG, T.BooleanType())])
        fn, step_type = self.fn, self.type_name

        def checked(rows: pd.DataFrame) -> pd.DataFrame:
            produced = fn(rows)
            wrong = set(produced.columns) - {*out_names, KEEP_FLAG, FAIL_FLAG} or set(out_names) - set(produced.columns)
            if wrong or len(produced) != len(rows):
                raise TransformError(f'Transform "{step_type}" returned other columns or rows than it declares.')
            return produced

        def isolated(rows: pd.DataFrame) -> pd.DataFrame:
            """The step's rows; a batch that raises is halved until the rows that do it stand alone and fail."""
            try:
                return checked(rows)
            except TransformError:
                raise
            except Exception:  # noqa: BLE001 - any error of user code is a failure of its row
                if len(rows) == 1:
                    return pd.DataFrame({**{n: [None] for n in out_names}, FAIL_FLAG: [True]})
            half = len(rows) // 2
            parts = [isolated(rows.iloc[:half].reset_index(drop=True)), isolated(rows.iloc[half:].reset_index(drop=True))]
            for part in parts:
                for flag, value in ((KEEP_FLAG, True), (FAIL_FLAG, False)):
                    if flag not in part.columns:
                        part[flag] = value
            return pd.concat([p.astype(object) for p in parts], ignore_index=True)

        def run(batch: pd.DataFrame, live: pd.Series) -> pd.DataFrame:
            live = live.astype(bool).to_numpy()
            result = pd.DataFrame({n: pd.Series([None] * len(batch), dtype=object) for n in out_names})
            result[KEEP_FLAG] = True
            result[FAIL_FLAG] = False
            if live.any():
                produced = isolated(batch[live].reset_index(drop=True))
                index = live.nonzero()[0]
                for c in out_names + [KEEP_FLAG, FAIL_FLAG]:
                    if c in produced.columns:
                        column = result[c].astype(object)
                        column.iloc[index] = produced[c].astype(object).to_numpy()
                        result[c] = column
            return result

        udf = F.pandas_udf(run, result_type)
        if not self.deterministic:
            udf = udf.asNondeterministic()
        struct = F.struct(*[row[n].alias(n) for n in names])
        result = udf(struct, row.live)
        cols = [(n, result.getField(n)) for n in out_names]
        return StepOutput(cols, fail=result.getField(FAIL_FLAG), keep=result.getField(KEEP_FLAG),
                          message="custom step failed")


def uppercase_provider(spec: StepSpec) -> Step:
    """Sample plug-in: ``{"type": "uppercase", "column": c}`` upper-cases the value's text form."""
    column = spec.values(column=text())["column"]

    def fn(row: RowView) -> StepOutput:
        field = row.require(column, "uppercase")
        upper = F.upper(stringify(row[column], field.dtype))
        return StepOutput([(n, upper if n == column else c) for n, c in row.passthrough()])

    return ColumnStep("uppercase", fn)


def filter_provider(spec: StepSpec) -> Step:
    """Sample plug-in: ``{"type": "filter", "condition": sql}`` drops rows where the Spark SQL
    condition is not true (counted as filtered, not as errors)."""
    condition = spec.values(condition=text())["condition"]

    class _Filter(Step):
        type_name = "filter"

        def build(self, row: RowView) -> StepOutput:
            from .base import SqlExpression

            return StepOutput(row.passthrough(), keep=SqlExpression(condition))  # type: ignore[arg-type]

    return _Filter()
