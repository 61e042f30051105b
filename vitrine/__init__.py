"""A PySpark engine that turns web-archive captures into a deduplicated image index."""
