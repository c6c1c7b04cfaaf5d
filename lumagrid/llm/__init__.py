"""Operators of a training-data pipeline; an optional part that nothing else in the library imports."""
