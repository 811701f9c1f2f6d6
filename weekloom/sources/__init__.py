"""Reading source tables and writing weekly tables."""
