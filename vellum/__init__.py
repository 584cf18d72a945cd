"""Document-register analytics as PySpark DataFrame operators."""
