"""Operators of the image library."""
