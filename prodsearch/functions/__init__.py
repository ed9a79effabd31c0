"""Column functions: text cleaning, formatting, markers, routing, vectors."""

from . import text, vector  # noqa: F401
