"""Schemas, run dates and readers."""

from kabuto.sources.schemas import RunDates  # noqa: F401
