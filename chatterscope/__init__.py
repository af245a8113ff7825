"""Post sentiment, keyword-trend and entity analytics as Spark DataFrame jobs."""
