"""Timetable punctuality analytics expressed as Spark DataFrame jobs."""

from stopwise.settings import Settings

__all__ = ["Settings"]
