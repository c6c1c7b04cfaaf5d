"""Streaming of the image library."""
