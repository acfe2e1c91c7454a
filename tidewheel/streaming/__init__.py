"""Features over event streams."""
