"""A PySpark toolkit that keeps a clean, de-duplicated roster from a licence registry."""
