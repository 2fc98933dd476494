"""Event-stream analytics on PySpark: operators, sources, sinks and ready jobs."""
