"""Structured Streaming forms of the incremental reads."""

from .incremental import run_incremental

__all__ = ["run_incremental"]
