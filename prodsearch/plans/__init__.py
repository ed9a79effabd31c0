"""End-to-end jobs: collect, preprocess, recommend."""

from . import collect, preprocess, recommend  # noqa: F401
