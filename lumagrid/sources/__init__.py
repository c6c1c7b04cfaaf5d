"""Sources of the image library."""
