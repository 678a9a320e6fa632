"""Structured Streaming jobs."""

from skyfold.streaming.incremental import accumulate  # noqa: F401
