"""A PySpark engine for program catalogs, text retrieval, call graphs and tool logs."""
