"""Incremental (file-arrival driven) processing on Structured Streaming."""

from tripmart.streaming.incremental import processed_periods, run_incremental, start_incremental

__all__ = ["processed_periods", "run_incremental", "start_incremental"]
