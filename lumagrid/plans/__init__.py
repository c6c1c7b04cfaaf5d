"""Plans of the image library."""
