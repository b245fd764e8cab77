"""Structured Streaming: the transform pipeline over ``readStream`` with a file sink."""

from .stream import METRICS_NAME, read_ledger, read_stream, start_stream_export, transform_stream

__all__ = ["METRICS_NAME", "read_ledger", "read_stream", "start_stream_export", "transform_stream"]
