"""Dimensional warehouse jobs for field-service businesses, written as Spark DataFrame plans."""

from martloom.settings import MartSettings

__all__ = ["MartSettings"]
