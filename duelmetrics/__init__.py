"""Head-to-head ratings analytics as PySpark DataFrame jobs."""
