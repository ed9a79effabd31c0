"""Structured Streaming jobs."""

from . import landing  # noqa: F401
