"""Rating analytics on Spark: tolerant ingestion, cleaning, analyses, marts and streams."""
