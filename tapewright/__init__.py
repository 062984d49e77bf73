"""Market-data and corpus analytics as PySpark DataFrame jobs."""
