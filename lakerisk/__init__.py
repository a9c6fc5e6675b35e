"""Entity risk ranking on a data lake, written as PySpark DataFrame jobs."""
