"""Plans: pipeline folding, configuration, contract, export orchestration and run tables."""

from .config import TransformConfig, build_pipeline, load_config, load_config_file, parse_inline
from .contract import OutputContract
from .export import ExportResult, column_manifest, describe, export, manifest_frame, write_manifest
from .paths import render_output
from .pipeline import ERROR_STRATEGIES, Pipeline, PipelineStep, PlannedFrame
from .runs import latest_runs, run_kpis, step_summary, step_view, with_throughput

__all__ = [
    "TransformConfig", "build_pipeline", "load_config", "load_config_file", "parse_inline",
    "OutputContract", "ExportResult", "column_manifest", "describe", "export", "manifest_frame", "write_manifest",
    "render_output", "ERROR_STRATEGIES", "Pipeline", "PipelineStep", "PlannedFrame", "latest_runs", "run_kpis",
    "step_summary", "step_view", "with_throughput",
]
