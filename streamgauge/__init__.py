"""Channel analytics as lazy PySpark DataFrame operators."""
