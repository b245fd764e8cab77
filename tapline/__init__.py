"""tapline: query results to exactly-shaped files, as Spark jobs.

A query (Spark SQL over registered tables, or a database query over JDBC) becomes a DataFrame;
an ordered list of declarative steps reshapes it with native column expressions; an error
strategy and an output contract guard it; sinks write JSON, NDJSON, CSV, TSV or Parquet with fixed
value rules and publish the result only when it is complete.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task-side helpers (pandas UDF bodies, JSON array framing) travel with the task by value, so
# executors need no installed copy of this package. Shipping it with --py-files also works.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .errors import OutputError, SourceError, TaplineError, TransformError
from .operators import StepRegistry, StepSpec, default_registry
from .plans import OutputContract, Pipeline, TransformConfig, build_pipeline, describe, export, load_config
from .session import build_session, drop_scratch, scratch_path, shared_dir, shuffles_freed

__all__ = [
    "OutputError", "SourceError", "TaplineError", "TransformError", "StepRegistry", "StepSpec",
    "default_registry", "OutputContract", "Pipeline", "TransformConfig", "build_pipeline", "describe", "export",
    "load_config", "build_session", "drop_scratch", "scratch_path", "shared_dir", "shuffles_freed",
]
