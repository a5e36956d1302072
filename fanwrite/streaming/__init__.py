"""Structured Streaming fan-out."""

from fanwrite.streaming.runner import FanoutJob, run_until_done

__all__ = ["FanoutJob", "run_until_done"]
