"""tidemark: snapshot ingest and table promotion as Spark DataFrame jobs."""
