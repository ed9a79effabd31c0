"""DataFrame -> DataFrame operators; column names are parameters."""

from . import clean, dialog, guard, joins, retrieve, stats  # noqa: F401
