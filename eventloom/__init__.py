"""Calendar-event analytics as PySpark DataFrame operators."""
