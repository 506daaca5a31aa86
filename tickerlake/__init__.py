"""Market-data ingestion, scoring and risk analytics as Spark DataFrame jobs."""
