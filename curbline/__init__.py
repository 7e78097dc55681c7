"""Fleet-observation analytics as PySpark DataFrame jobs."""
